import os

import pytest

import corpus_pipeline as P
from lmplake.llm import common, decontaminate, langid, minhash, mixing, tokens
from lmplake.llm.queries import QUERIES
from tests.llm.brute import near_classes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, f in P.STAGES[:-1]:
        nxt = f(spark, out[-1], SF)
        assert nxt.columns == docs.columns
        out.append(spark.createDataFrame(nxt.collect(), docs.schema).repartition(3))
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_order():
    assert [n for n, _ in P.STAGES] == ["language_id", "near_dedup", "decontaminate", "mix_sources", "token_ids"]


def test_stages_against_brute_force(spark, stages):
    docs, known, unique, clean, mixed = stages
    rows = {r["doc_id"]: r for r in docs.collect()}
    # language: rows without a letter go, others with a sure language stay
    pred = {r["doc_id"]: r for r in langid.predict(docs, langid.fit(docs), carry=["doc_id"]).collect()}
    assert ids(known) == sorted(d for d in rows if pred[d]["lang_pred"] != "und" and pred[d]["score"] >= P.MIN_SCORE)
    assert len(ids(known)) >= 0.95 * len(rows)
    # near-duplicates: the smallest of each class
    classes = near_classes([(d, rows[d]["text"]) for d in ids(known)])
    assert ids(unique) == sorted(set(classes.values()))
    # benchmark: no verbatim item is left, documents far from all items stay
    items = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    flat = {d: " ".join(rows[d]["text"].lower().split()) for d in ids(unique)}
    leaky = {d for d, t in flat.items() if any(i in t for i in items)}
    assert set(ids(clean)) <= set(flat) - leaky
    assert len(ids(clean)) >= 0.98 * (len(flat) - len(leaky))
    # mix: sources reach their targets, to the word
    size, taken = {}, {}
    for r in clean.collect():
        size[r["source"]] = size.get(r["source"], 0) + len(r["text"].split())
    for r in mixed.collect():
        taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
        assert rows[r["doc_id"]]["text"].startswith(r["text"]) and r["n_chars"] == len(r["text"])
    order = sorted(size, key=lambda s: s.encode())
    target = mixing.water_fill([size[s] for s in order], [1.0 + i % 3 for i in range(len(order))], 3)
    assert all(abs(taken.get(s, 0) - t) <= 1 for s, t in zip(order, target))
    # tokens: every row's sequences, in one permuted order
    out = P.token_ids(spark, mixed, SF).collect()
    enc = tokens.load()
    assert sum(r["n_tokens"] for r in out) == sum(len(enc.encode_ordinary(r["text"])) + 1 for r in mixed.collect())
    assert sorted(r["slot"] for r in out) == list(range(len(out)))


def test_stages_take_hard_rows(spark, frame):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size long, s string, b string, take long, " \
             "target double, draws string, _text string, row string, name string, leaks string, lang_pred string, score double, _letters int, " \
             "h string, n long, source_size int"
    rest = (7, "s", "b", 8, 0.5, "d", "t", "r", "n", "l", "p", 0.25, 1, "h", 9, 3)
    clean, other = "le la les " * 12, "der die das und ist " * 9
    rows = [(1, None, None, None, None), (None, "the the", "en", None, 7), (2, "", "en", "a", 0), (3, clean, "fr", "b", 9),
            (3, clean, "fr", "b", 9), (4, "der die das", None, "b", 11), (5, "12 34", "en", "a", 5), (6, "x " * 50_000, "en", "a", 100_000),
            (7, other, "de", "b", 1), (7, "que los las una " * 9, "es", "b", 1), (8, other, "de", "a", 1), (None, "the the", "en", None, 7),
            (None, other, "de", None, 1)]
    docs = frame([r + rest for r in rows], schema)
    for name, f in P.STAGES:
        out = f(spark, docs, SF)
        assert name == "token_ids" or out.columns == docs.columns
        got = out.collect()
        assert len(got) <= 300 and f(spark, frame([], schema), SF).collect() == []
        if name != "token_ids":
            assert {tuple(r)[5:] for r in got} == {rest}
    kept = P.near_dedup(spark, docs, SF).collect()
    # of id 7 both texts stay; 8 and the row without id are copies of one of them
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "2", "3", "4", "5", "6", "7", "7", "None"]
    assert sorted(r["text"] for r in kept if r["doc_id"] == 7) == [other, "que los las una " * 9]
    known = P.language_id(spark, docs, SF).collect()
    assert known and not {1, 2, 5} & {r["doc_id"] for r in known}
    assert sum(r["text"].count("x") for r in P.mix_sources(spark, docs, SF).collect() if r["doc_id"] == 6) > 0


def test_a_stage_leaves_only_its_result(spark, frame, monkeypatch):
    made, gone = [], []
    monkeypatch.setattr(common, "remove", lambda spark, path, f=common.remove: (gone.append(path), f(spark, path)))
    monkeypatch.setattr(common, "lake_root", lambda spark, f=common.lake_root: (made.append(f(spark)), made[-1])[1])
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = P.near_dedup(spark, docs, SF)
    left = {m for m in made if not any(g.startswith(m) for g in gone)}
    assert len(made) > 5 and len(left) == 1  # the classes
    assert 0 < got.count() < docs.count()


def test_run(spark):
    out = P.run(spark, SF)
    assert {"slot", "shard", "ids", "doc_id"} <= set(out.columns) and out.count() > 0


def test_registered():
    import importlib.util
    spec = importlib.util.spec_from_file_location("entry", os.path.join(os.path.dirname(P.__file__), "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    names = entry.queries()
    assert "pipeline" in names and {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) <= set(names) and "op10_chat_format" in entry.oracle_sql()
    assert decontaminate.RECALL >= 0.9 and minhash.THRESHOLD == 0.8
