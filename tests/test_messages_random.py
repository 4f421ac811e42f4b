"""Random control messages decoded by Spark against a plain-Python model."""
import datetime as dt
import json
import random

from lmplake.feeds import FEEDS
from lmplake.functions.messages import decode_messages

FEED_NAMES = list(FEEDS) + ["x", "DA_HRL_LMPS"]


def _message(rng):
    kind = rng.choice(["fetch", "merge", "junk", "partial"])
    if kind == "fetch":
        t = dt.datetime(2020, 1, 1) + dt.timedelta(minutes=5 * rng.randrange(0, 500_000))
        off = rng.choice([-300, -240, 0, 60, 330])
        local = t + dt.timedelta(minutes=off)
        sign = "-" if off < 0 else "+"
        text = local.strftime("%Y-%m-%dT%H:%M:%S") + f"{sign}{abs(off) // 60:02d}{abs(off) % 60:02d}"
        if rng.random() < 0.1:
            text = text.replace("T", " ")  # wrong format
        body = {"begin_time_iso_str": text, "pjm_end_point": rng.choice(FEED_NAMES),
                "queue_next": rng.choice([True, False, "true"])}
    elif kind == "merge":
        body = {"date": (dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(0, 2000))).isoformat(),
                "endpoint": rng.choice(FEED_NAMES)}
    elif kind == "partial":
        body = {"begin_time_iso_str": "2024-01-01T00:00:00+0000", "pjm_end_point": "da_hrl_lmps"}
    else:
        return rng.choice(["", "{", "null", "[1,2]", '"just text"'])
    text = json.dumps(body)
    if rng.random() < 0.4:
        text = '"' + text.replace('"', '\\"') + '"'
    return text


def _model(text):
    if len(text) >= 2 and text[0] == '"' and text[-1] == '"':
        text = text[1:-1]
    text = text.replace('\\"', '"')
    try:
        m = json.loads(text)
    except ValueError:
        return ("bad", None, None, None, None)
    if not isinstance(m, dict):
        return ("bad", None, None, None, None)
    b, f, q = m.get("begin_time_iso_str"), m.get("pjm_end_point"), m.get("queue_next")
    if isinstance(b, str) and isinstance(q, bool) and f in FEEDS:
        try:
            begin = dt.datetime.strptime(b, "%Y-%m-%dT%H:%M:%S%z").astimezone(dt.timezone.utc).replace(tzinfo=None)
            return ("fetch", f, begin, q, None)
        except ValueError:
            pass
    d, e = m.get("date"), m.get("endpoint")
    if isinstance(d, str) and isinstance(e, str):
        return ("merge", e, None, None, dt.date.fromisoformat(d))
    return ("bad", None, None, None, None)


def test_random_messages_decode_like_the_model(spark):
    rng = random.Random(11)
    texts = [_message(rng) for _ in range(3000)]
    rows = decode_messages(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    bad = [(r.value, (r.kind, r.feed, r.begin_utc, r.queue_next, r.merge_date), _model(r.value))
           for r in rows if (r.kind, r.feed, r.begin_utc, r.queue_next, r.merge_date) != _model(r.value)]
    assert len(rows) == 3000 and not bad, bad[:5]
