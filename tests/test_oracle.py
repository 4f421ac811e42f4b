"""Every registered query against its DuckDB statement at sf0.01, the way
the driver checks them (names, types, multiset of rows)."""
import os

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    """All of the lake's own queries have one (the training-data part says which of its do)."""
    from lmplake.plans.registry import QUERIES
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(E.queries()[key](spark, SF), con, E.oracle_sql()[key])
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.schema == E.entry(spark).schema


def test_writing_keys_repeat_in_one_session(spark):
    """Keys that write lake tables use a fresh folder per call, so calling
    them twice (as a checker may) gives the same rows."""
    for key in ("stream_day_merge", "fetch_cycle", "intake_sweep"):
        first = sorted(map(tuple, E.queries()[key](spark, SF).collect()))
        second = sorted(map(tuple, E.queries()[key](spark, SF).collect()))
        assert first == second, key
