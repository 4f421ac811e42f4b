import datetime as dt


from lmplake.operators.pulls import first_day_filter, next_requests, page_completeness, page_plan


def test_page_plan_golden(spark):
    totals = spark.createDataFrame([(0, 0), (1, 1), (2, 50000), (3, 50001), (4, 150000)], "pull int, total_rows bigint")
    plan = page_plan(totals, ["pull"]).collect()
    per = {}
    for r in plan:
        per.setdefault(r.pull, []).append(r.start_row)
    assert {k: sorted(v) for k, v in per.items()} == {1: [1], 2: [1], 3: [1, 50001], 4: [1, 50001, 100001]}


def test_page_completeness_detects_missing_page(spark):
    headers = spark.createDataFrame([("a", 120000), ("b", 10)], "pull string, total_rows bigint")
    got = spark.createDataFrame([("a", 1, 50000), ("a", 100001, 20000), ("b", 1, 10)],
                                "pull string, start_row bigint, n_rows bigint")
    r = {x.pull: x for x in page_completeness(got, headers, ["pull"]).collect()}
    assert (r["a"].missing_pages, r["a"].complete) == (1, False)
    assert (r["b"].missing_pages, r["b"].complete) == (0, True)


def test_first_day_filter_keeps_earliest_day_per_pull(spark):
    df = spark.createDataFrame([("p", dt.date(2024, 1, 1), 1), ("p", dt.date(2024, 1, 2), 2), ("q", dt.date(2024, 1, 2), 3)],
                               "pull string, pricedate date, v int")
    assert sorted(r.v for r in first_day_filter(df, ["pull"]).collect()) == [1, 3]


def test_next_requests_continue_or_retry(spark):
    req = spark.createDataFrame([
        ("da_hrl_lmps", "r1", dt.datetime(2024, 1, 1, 5), True),
        ("da_hrl_lmps", "r2", dt.datetime(2024, 1, 2, 5), True),
        ("rt_fivemin_hrl_lmps", "r3", dt.datetime(2024, 1, 1, 5), False),
    ], "feed string, rid string, begin_utc timestamp_ntz, queue_next boolean")
    pulled = spark.createDataFrame([
        ("da_hrl_lmps", "r1", dt.datetime(2024, 1, 1, 5)), ("da_hrl_lmps", "r1", dt.datetime(2024, 1, 2, 4)),
        ("rt_fivemin_hrl_lmps", "r3", dt.datetime(2024, 1, 1, 5, 5)),
    ], "feed string, rid string, utcbegin timestamp_ntz")
    out = {r.rid: r for r in next_requests(req, pulled, ["feed", "rid"], "2024-06-01 00:00:00").collect()}
    assert out["r1"].next_begin_utc == dt.datetime(2024, 1, 2, 5) and out["r1"].delay_secs == 60
    assert out["r2"].next_begin_utc == dt.datetime(2024, 1, 2, 5) and out["r2"].n_rows == 0
    assert "r3" not in out  # had rows and did not ask to continue
