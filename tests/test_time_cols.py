import datetime as dt

import pytest

from lmplake.feeds import DA_FEED, feed
from lmplake.functions.time_cols import (
    api_time_text, floor_to_step, hour_ending, market_date, parse_iso_offset, parse_utc_strict, parse_utc_tolerant,
)
from lmplake.operators.normalize import normalize_prices

ZONES = ["UTC", "Asia/Tokyo", "America/New_York"]
GOLDEN = [
    ("2024-03-10T06:00:00", dt.date(2024, 3, 10), 2),
    ("2024-03-10T07:00:00", dt.date(2024, 3, 10), 4),
    ("2024-11-03T05:00:00", dt.date(2024, 11, 3), 2),
    ("2024-11-03T06:00:00", dt.date(2024, 11, 3), 2),
    ("2024-11-04T04:00:00", dt.date(2024, 11, 3), 24),
    ("2024-11-04T05:00:00", dt.date(2024, 11, 4), 1),
]


@pytest.fixture(params=ZONES)
def zoned(spark, request):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield spark
    spark.conf.set("spark.sql.session.timeZone", old)


def test_local_date_and_hour_golden(zoned):
    df = zoned.createDataFrame([(g[0],) for g in GOLDEN], "s string")
    u = parse_utc_strict("s")
    got = df.select("s", market_date(u).alias("d"), hour_ending(u).alias("h")).collect()
    assert sorted((r.s, r.d, r.h) for r in got) == sorted(GOLDEN)


def test_utcbegin_is_wall_time_in_any_zone(zoned):
    df = zoned.createDataFrame([("2024-03-10T07:32:10",)], "s string")
    r = df.select(parse_utc_strict("s").alias("u"), floor_to_step(parse_utc_strict("s"), 5).alias("f"),
                  api_time_text(parse_utc_strict("s")).alias("t")).first()
    assert r.u == dt.datetime(2024, 3, 10, 7, 32, 10)
    assert r.f == dt.datetime(2024, 3, 10, 7, 30)
    assert r.t == "03-10-2024 07:32"


def test_session_free_text_in_the_spring_gap(zoned):
    df = zoned.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30),)], "t timestamp_ntz")
    assert df.select(api_time_text("t").alias("x")).first().x == "03-10-2024 02:30"


@pytest.mark.parametrize("bad", ["2024-13-01T00:00:00", "2024-01-01 00:00:00", "2024-01-01T00:00:00Z"])
def test_strict_parse_raises_and_tolerant_gives_null(spark, bad):
    df = spark.createDataFrame([(bad,)], "s string")
    with pytest.raises(Exception):
        df.select(parse_utc_strict("s")).collect()
    assert df.select(parse_utc_tolerant("s").alias("u")).first().u is None


def test_hourly_grid_on_spring_day_has_23_cells(spark):
    from lmplake.operators.quality import interval_grid
    b = spark.createDataFrame([("x", dt.datetime(2024, 3, 10, 5), dt.datetime(2024, 3, 11, 3))],
                              "k string, lo timestamp_ntz, hi timestamp_ntz")
    assert interval_grid(b, ["k"], 60).count() == 23


@pytest.mark.parametrize("text,expected", [
    ("2024-11-03T01:30:00-0400", dt.datetime(2024, 11, 3, 5, 30)),
    ("2024-11-03T06:30:00+0000", dt.datetime(2024, 11, 3, 6, 30)),
    ("junk", None),
])
def test_offset_time_decode(zoned, text, expected):
    df = zoned.createDataFrame([(text,)], "s string")
    assert df.select(parse_iso_offset("s").alias("u")).first().u == expected


def test_normalize_reads_integral_prices_and_nulls(spark, tmp_path):
    from lmplake.sources.pages import read_json_pages
    from lmplake.feeds import RT_VERIFIED_FEED
    page = tmp_path / "page1.json"
    page.write_text(
        '[{"datetime_beginning_utc":"2024-03-10T06:00:00","pnode_id":2156110049,"total_lmp_rt":20,'
        '"congestion_price_rt":0.5,"marginal_loss_price_rt":-0.1},\n'
        ' {"datetime_beginning_utc":"2024-03-10T07:00:00","pnode_id":45565887,"total_lmp_rt":21.25,'
        '"congestion_price_rt":0,"marginal_loss_price_rt":null}]')
    spec = feed(RT_VERIFIED_FEED)
    rows = normalize_prices(read_json_pages(spark, str(tmp_path), spec), spec).orderBy("utcbegin").collect()
    assert [(r.node_id, r.rtlmp, r.rtmcc, r.rtmcl, r.hour) for r in rows] == [
        (2156110049, 20.0, 0.5, -0.1, 2), (45565887, 21.25, 0.0, None, 4)]
    assert spec.price_schema()["hour"].dataType.simpleString() == "int"


def test_quarantine_splits_bad_rows(spark):
    from lmplake.operators.normalize import split_quarantine
    spec = feed(DA_FEED)
    raw = spark.createDataFrame([
        ("2024-01-01T05:00:00", "1", "10.5", None, "1"),
        ("2024-01-01 05:00:00", "2", "1", "1", "1"),
        ("2024-01-01T06:00:00", "x", "1", "1", "1"),
        ("2024-01-01T07:00:00", "3", "abc", "1", "1"),
    ], ",".join(f"{c} string" for c in spec.api_fields))
    good, bad = split_quarantine(raw, spec)
    assert good.count() == 1 and good.first().damcc is None
    assert sorted(r.reason for r in bad.collect()) == ["bad_node", "bad_time", "bad_total_lmp_da"]


def test_pages_are_read_once_with_numbers_as_sent(spark, tmp_path):
    """Numbers that are read as text keep their literal text, without another read of the file for each."""
    from lmplake.feeds import DA_FEED
    from lmplake.sources.pages import read_json_pages
    spec = feed(DA_FEED)
    numbers = ["20", "20.10", "-0.5", "1E3", "123456789012345678901234567890"]
    rec = '{"datetime_beginning_utc":"2024-03-10T06:00:00","pnode_id":%d,"total_lmp_da":%s,"congestion_price_da":0.50,"marginal_loss_price_da":null}'
    texts = [rec % (i, numbers[i % len(numbers)]) for i in range(400)]
    for k, sep in enumerate((",", ",\n", ",\r\n ")):  # a page may hold line breaks
        (tmp_path / f"page{k}.json").write_text("[" + sep.join(texts[k::3]) + "]\n", newline="")
    (tmp_path / "empty.json").write_text("[]")
    size = sum(p.stat().st_size for p in tmp_path.iterdir())
    seen = lambda: sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before = seen()
    got = read_json_pages(spark, str(tmp_path), spec).collect()
    assert seen() - before < 4 * size
    assert {(int(r.pnode_id), r.total_lmp_da, r.congestion_price_da, r.marginal_loss_price_da) for r in got} == \
        {(i, numbers[i % len(numbers)], "0.50", None) for i in range(400)}
    assert len(got) == 400 and {r.file_path.rsplit("/", 1)[-1] for r in got} == {"page0.json", "page1.json", "page2.json"}
    (tmp_path / "cut.json").write_text("[" + texts[0] + ",")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_json_pages(spark, str(tmp_path), spec).collect()
