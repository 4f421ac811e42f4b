import base64
import datetime as dt
import json


from lmplake.functions.messages import base64_text, decode_messages, fetch_message_json, queue_name


def _decode(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return decode_messages(df).collect()


def test_fetch_plain_and_quoted(spark):
    plain = '{"begin_time_iso_str":"2024-11-03T01:30:00-0400","pjm_end_point":"da_hrl_lmps","queue_next":true}'
    quoted = '"' + plain.replace('"', '\\"') + '"'
    for r in _decode(spark, [plain, quoted]):
        assert (r.kind, r.feed, r.begin_utc, r.queue_next) == ("fetch", "da_hrl_lmps", dt.datetime(2024, 11, 3, 5, 30), True)


def test_unknown_feed_falls_through_to_merge_then_bad(spark):
    unknown = '{"begin_time_iso_str":"2024-01-01T00:00:00+0000","pjm_end_point":"x","queue_next":true}'
    merge = '{"date":"2024-01-05","endpoint":"rt_fivemin_hrl_lmps"}'
    junk = 'not json'
    r = _decode(spark, [unknown, merge, junk])
    assert [x.kind for x in r] == ["bad", "merge", "bad"]
    assert r[1].merge_date == dt.date(2024, 1, 5) and r[1].feed == "rt_fivemin_hrl_lmps"


def test_encode_round_trip(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), "rt_fivemin_hrl_lmps")], "b timestamp_ntz, feed string")
    m = fetch_message_json("b", "feed")
    r = df.select(m.alias("m"), base64_text(m).alias("p"), queue_name("feed").alias("q")).first()
    assert json.loads(r.m) == {"begin_time_iso_str": "2024-01-01T05:00:00+0000",
                               "pjm_end_point": "rt_fivemin_hrl_lmps", "queue_next": True}
    assert base64.b64decode(r.p).decode() == r.m and r.q == "rtfiveminhrllmps"
    back = decode_messages(spark.createDataFrame([(r.m,)], "value string")).first()
    assert back.kind == "fetch" and back.begin_utc == dt.datetime(2024, 1, 1, 5)


def test_envelopes_and_days_that_do_not_exist(spark):
    merge = '{"date":"2024-01-05","endpoint":"rt_fivemin_hrl_lmps"}'
    quoted = json.dumps(merge)
    texts = [json.dumps({"Data": {"queueItem": merge}, "Metadata": {"a": 1}}), json.dumps({"Data": {"queueItem": quoted}}), merge, quoted,
             '{"date":"2024-13-40","endpoint":"x"}', '{"Data": {}}', '{"Data": 5}', "not json", None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert [r.kind for r in decode_messages(df, envelope=True).collect()] == ["merge"] * 4 + ["bad"] * 5
