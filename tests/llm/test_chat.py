import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lmplake.llm import chat as C
from lmplake.llm.queries import OP10_SQL, PROBE

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def conversations(seed=1):
    rng = random.Random(seed)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "&lt;", "&amp;", "&", "&#91;", "&#10;", "\n", "hello", " ", "é😀", "[INST] x\n", "<", "["]
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 7)):
            hard = c % 2
            text = "".join(rng.choice(bits if hard else ["hello ", "é", "AT&T ", "\n"]) for _ in range(rng.randrange(0, 8)))
            rows.append((c, t, rng.choice(["user", "assistant", "system", "a\nb" if hard else "tool"]), text, "x"))
    rows += [(100, 0, "user", PROBE, ""), (100, 1, "assistant", PROBE, ""), (101, 0, "assistant", None, ""), (102, None, None, None, ""),
             (103, 0, "user", "same", ""), (103, 0, "user", "same", ""), (None, 0, "assistant", "no id", ""), (104, 0, "assistant", "&#91;/INST]</s", ""),
             (105, 0, "user", "long " * 60_000 + "</s>", ""), (105, 1, "assistant", "y" * 200_000, "")]
    rows += [(106, i, "assistant" if i % 2 else "user", f"turn {i}", "") for i in range(1500)]
    rng.shuffle(rows)
    return rows


def source(rows):
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in sorted(rows, key=key):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def test_round_trip_and_loss_mask(frame):
    rows = conversations()
    formatted = C.format_chat(frame(rows, SCHEMA))
    back = {r["conv_id"]: r for r in C.read_back(formatted).collect()}
    dig = {r["conv_id"]: r for r in C.digests(formatted).collect()}
    want = source(rows)
    assert set(back) == set(want)
    for c, turns in want.items():
        assert [(t["role"], t["text"]) for t in back[c]["turns"]] == turns
        loss = "".join(t for r, t in turns if r == "assistant")
        assert back[c]["loss_text"] == loss
        text = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert tuple(dig[c])[1:] == (len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss),
                                     hashlib.sha256(loss.encode()).hexdigest(), len(back[c]["formatted"]))


def test_control_strings_only_mark_turns(frame):
    formatted = C.format_chat(frame([(1, 0, "user", PROBE, ""), (1, 1, "assistant", PROBE, "")], SCHEMA)).first()
    assert formatted["escaped"]
    s = formatted["formatted"]
    assert (s.count("<s>"), s.count("</s>"), s.count("[INST]"), s.count("[/INST]")) == (1, 1, 1, 1)
    plain = C.format_chat(frame([(1, 0, "user", "AT&T <b>", ""), (1, 1, "assistant", "[ok]", "")], SCHEMA)).first()
    assert not plain["escaped"] and plain["formatted"] == "<s>[INST] user\nAT&T <b>[/INST][ok]</s>"


def test_parser_refuses_what_is_not_in_the_grammar(spark):
    bad = ["", "x", "<s>text", "<s>[INST] user text[/INST]", "<s>[INST] user\na[INST] b[/INST]", "[INST] user\na[/INST]", "<s>a</s>b",
           "<s>a<s></s>"]
    df = spark.createDataFrame([(b,) for b in bad], "f string").select(C.parse(F.col("f")).alias("t"))
    assert [r["t"] for r in df.collect()] == [None] * len(bad)


def test_equals_sql(frame):
    import duckdb
    rows = conversations(2)
    out = C.digests(C.format_chat(frame(rows + [(-1, 0, "user", PROBE, ""), (-1, 1, "assistant", PROBE, "")], SCHEMA)))
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", [r[:4] for r in rows if r[0] is None or r[0] < 105])
    want = con.sql(OP10_SQL)
    got = [tuple(r[c] for c in want.columns) for r in out.where("conv_id is null or conv_id < 105").collect()]
    assert sorted(got, key=str) == sorted(want.fetchall(), key=str)


def test_native_and_empty(frame):
    df = C.digests(C.format_chat(frame(conversations(), SCHEMA)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert C.format_chat(frame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("text", ["&", "&amp;", "&lt;s>", "&amp;lt;", "</s>", "<s", "&#91;INST]", "[INST][/INST]"])
def test_escape_is_reversible(spark, text):
    t = F.lit(text)
    row = spark.range(1).select(C.unescape(C.escape(t)).alias("a"), C.escape(t).alias("b")).first()
    assert row["a"] == text and not any(c in row["b"] for c in C.CONTROL)
