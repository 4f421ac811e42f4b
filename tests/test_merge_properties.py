"""Randomised merge properties against a plain-Python model of latest-wins."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lmplake.operators.merge import carried_over_nodes, merge_rows
from pyspark.sql import functions as F

SCHEMA = "node_id bigint, utcbegin timestamp_ntz, v double, ingest_seq bigint"
T0 = dt.datetime(2024, 1, 1, 5)

row = st.tuples(st.integers(1, 4), st.integers(0, 30), st.integers(-50, 50))
batch = st.lists(row, max_size=25)


def _frame(spark, rows, seq0):
    data = [(n, T0 + dt.timedelta(hours=h), float(v), seq0 + i) for i, (n, h, v) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA), data


def _model(existing, new):
    out = {}
    for src, rows in ((0, existing), (1, new)):
        for n, t, v, s in rows:
            k = (n, t)
            if k not in out or (src, s) > out[k][0]:
                out[k] = ((src, s), v)
    return {(k[0], k[1], v) for k, (_, v) in out.items()}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(existing=batch, new=batch)
def test_merge_matches_model_and_keeps_carried_nodes(spark, existing, new):
    e, e_rows = _frame(spark, existing, 1000)
    n, n_rows = _frame(spark, new, 5000)
    merged = merge_rows(e, n)
    got = {(r.node_id, r.utcbegin, r.v) for r in merged.collect()}
    assert got == _model(e_rows, n_rows)
    # replaying the new batch changes nothing
    assert {(r.node_id, r.utcbegin, r.v) for r in merge_rows(merged, n).collect()} == got
    # nodes with no new rows on a day keep exactly their existing rows
    day = F.to_date("utcbegin")
    carried = carried_over_nodes(e.withColumn("pricedate", day), n.withColumn("pricedate", day)).collect()
    for c in carried:
        before = {(x[0], x[1], x[2]) for x in e_rows if x[0] == c.node_id and x[1].date() == c.pricedate}
        before_latest = _model([x for x in e_rows if x[0] == c.node_id and x[1].date() == c.pricedate], [])
        after = {g for g in got if g[0] == c.node_id and g[1].date() == c.pricedate}
        assert after == before_latest and after <= before
