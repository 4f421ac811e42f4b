"""Golden and model checks for day completeness, page plans and freshness."""
import datetime as dt
import math
import random
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from lmplake.functions.time_cols import market_date
from lmplake.operators.pulls import page_plan
from lmplake.operators.quality import day_completeness, freshness_report

NY, UTC = ZoneInfo("America/New_York"), dt.timezone.utc


def _hours_of(day):
    start = dt.datetime.combine(day, dt.time(), NY).astimezone(UTC)
    end = dt.datetime.combine(day + dt.timedelta(days=1), dt.time(), NY).astimezone(UTC)
    n = int((end - start).total_seconds() // 3600)
    return [(start + dt.timedelta(hours=h)).replace(tzinfo=None) for h in range(n)]


def test_civil_days_of_23_24_25_hours_are_complete_only_when_full(spark):
    days = [dt.date(2024, 3, 10), dt.date(2024, 1, 2), dt.date(2024, 11, 3)]
    rows = [("full", u) for d in days for u in _hours_of(d)]
    rows += [("gap", u) for d in days for u in _hours_of(d)[:-1]]  # last hour missing
    df = spark.createDataFrame(rows, "g string, utcbegin timestamp_ntz").withColumn("pricedate", market_date("utcbegin"))
    got = {(r.g, r.pricedate): (r.n_intervals, r.expected_intervals, r.complete)
           for r in day_completeness(df, ["g"], 60).collect()}
    assert got[("full", days[0])] == (23, 23, True)
    assert got[("full", days[1])] == (24, 24, True)
    assert got[("full", days[2])] == (25, 25, True)
    assert got[("gap", days[2])] == (24, 25, False)


def test_page_plan_matches_a_model(spark):
    rng = random.Random(3)
    cases = [(i, rng.choice([0, 1, rng.randrange(1, 10_000), rng.randrange(1, 200_000)]), rng.choice([1, 7, 500, 50_000]))
             for i in range(200)]
    rows = []
    for size in sorted({c[2] for c in cases}):
        totals = spark.createDataFrame([(i, t) for i, t, s in cases if s == size], "pull int, total_rows bigint")
        rows += [(size, r.pull, r.start_row) for r in page_plan(totals, ["pull"], page_size=size).collect()]
    expected = sorted((s, i, p * s + 1) for i, t, s in cases for p in range(math.ceil(t / s)))
    assert sorted(rows) == expected


def test_freshness_golden(spark):
    df = spark.createDataFrame([
        ("rt_fivemin_hrl_lmps", "a", dt.datetime(2024, 3, 8, 14, 55)),   # Friday; next interval 15:00 UTC
        ("da_hrl_lmps", "b", dt.datetime(2024, 1, 2, 4)),                # next 05:00 UTC, expected 14 h before
    ], "feed string, pull string, utcbegin timestamp_ntz")
    got = {r.pull: r for r in freshness_report(df, ["feed", "pull"], "2024-03-11 15:00:00").collect()}
    assert got["a"].expected_at == dt.datetime(2024, 3, 11, 14) and got["a"].overdue_secs == 3600
    assert got["b"].expected_at == dt.datetime(2024, 1, 1, 15)
