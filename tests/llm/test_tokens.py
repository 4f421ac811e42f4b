import random

import numpy as np
import pytest

from lmplake.llm import tokens as K

TRICKY = ["", "  ", "a", "don't 'tis  it's\n\n 'll we'll'd x'", "\n\n  foo\t bar 12ab  \n", " 'S 'RE", "a b　 c", "😀 ok",
          "'s", "x's's", "\x00\x1c\x1f \x85y", "ein Wort", "x" * 500]


def texts(n=400):
    rng = random.Random(1)
    return TRICKY + ["".join(rng.choice(" \n\t'sretvmld1é中.,! ٣") for _ in range(rng.randrange(40))) for _ in range(n)]


def test_same_ids_as_the_library():
    tok = K.Tokenizer(K.VOCABULARY)
    for batch in (texts(), texts()[::-1], ["only"]):
        ids, at = tok.encode(batch)
        for i, t in enumerate(batch):
            assert ids[at[i]:at[i + 1]].tolist() == [*tok.enc.encode_ordinary(t), K.END_OF_TEXT]


def test_a_full_memo_starts_anew(monkeypatch):
    monkeypatch.setattr(K, "MEMO", 40)
    tok = K.Tokenizer(K.VOCABULARY)
    for t in texts(60):
        assert tok.encode([t])[0].tolist() == [*tok.enc.encode_ordinary(t), K.END_OF_TEXT]


def test_every_sequence_has_one_slot_and_texts_come_back(frame, tmp_path):
    rows = [(i, t, "x") for i, t in enumerate(texts(120))] + [(None, "null key", "x"), (7, None, "x"), (3, "same", "x"), (3, "same", "x"),
                                                             (800, "long text " * 20_000, "x")]
    df = frame(rows, "doc_id long, text string, slot string")
    ordered = K.training_order(df, seq_len=32, shard_rows=50)
    out = ordered.collect()
    assert sorted(r["slot"] for r in out) == list(range(len(out)))
    assert all(r["shard"] == r["slot"] // 50 and r["row"] == r["slot"] % 50 and len(r["ids"]) == 64 for r in out)
    enc = K.load(K.VOCABULARY)
    want = sorted((str(d), tuple(enc.encode_ordinary(t or ""))) for d, t, _ in rows if d not in (3, 7))
    docs = {}
    for r in sorted(out, key=lambda r: r["part"]):
        if r["doc_id"] not in (3, 7):
            docs.setdefault(str(r["doc_id"]), []).extend(np.frombuffer(r["ids"], "<u2")[:r["n_tokens"]].tolist())
    assert sorted((d, tuple(v[:-1])) for d, v in docs.items()) == want
    assert all(v[-1] == K.END_OF_TEXT for v in docs.values())
    assert sum(r["n_tokens"] for r in out if r["doc_id"] == 3) == 2 * (len(enc.encode_ordinary("same")) + 1) + \
        len(enc.encode_ordinary(rows[3][1])) + 1
    # files: fixed stride, any slot can be read by itself, and writing again replaces
    folder = f"file://{tmp_path}/shards"
    for _ in range(2):
        manifest = K.write_shards(K.training_order(df, seq_len=32, shard_rows=50), folder).collect()
    assert sorted(m["shard"] for m in manifest) == list(range(-(-len(out) // 50)))
    by_slot = {r["slot"]: r["ids"] for r in out}
    for m in manifest:
        assert m["first_slot"] == m["shard"] * 50
        for row in range(m["rows"]):
            assert K.read_sequence(m["path"], row, 32).tobytes() == bytes(by_slot[m["first_slot"] + row])
    assert not [p for p in (tmp_path / "shards").iterdir() if p.name.startswith("_")]
    # what the query returns comes from the files
    back = K.materialised(df, seq_len=32, shard_rows=50)
    assert back.columns == ordered.columns and sorted(map(repr, back.collect())) == sorted(map(repr, out))


def test_a_reader_resumes_in_the_middle_and_a_short_file_fails(frame, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "READ_ROWS", 3)
    df = frame([(i, t, "x") for i, t in enumerate(texts(40))], "doc_id long, text string, slot string")
    folder = f"file://{tmp_path}/shards"
    index = K.index_shards(K.training_order(df, seq_len=16, shard_rows=20), folder).cache()
    want = {r["slot"]: bytes(r["ids"]) for r in K.training_order(df, seq_len=16, shard_rows=20).collect()}
    assert index.count() == len(want)
    rest = K.read_shards(index.where("slot >= 27 and slot % 5 <> 0"), folder, seq_len=16).collect()
    assert {r["slot"]: bytes(r["ids"]) for r in rest} == {s: v for s, v in want.items() if s >= 27 and s % 5}
    path = index.where("slot = 0").first()["path"]
    with open(path, "r+b") as f:
        f.truncate(16 * 2 * 4)
    with pytest.raises(Exception, match="ends before row"):
        K.read_shards(index, folder, seq_len=16).collect()


def test_empty(frame):
    assert K.training_order(frame([], "doc_id long, text string")).collect() == []
    assert K.materialised(frame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_another_key_is_another_order(frame, seed):
    df = frame([(i, "a b c", "") for i in range(100)], "doc_id long, text string, x string", parts=1)
    a = [r["doc_id"] for r in K.training_order(df, seed=seed).orderBy("slot").collect()]
    b = [r["doc_id"] for r in K.training_order(df, seed=seed).orderBy("slot").collect()]
    assert a == b and a != sorted(a)


def test_words_whose_polynomial_hashes_are_equal():
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    tok, enc = K.Tokenizer(K.VOCABULARY), K.load()
    ids, at = tok.encode([one, two])
    assert [ids[a:b - 1].tolist() for a, b in zip(at[:-1], at[1:])] == [enc.encode_ordinary(t) for t in (one, two)]


def test_waves_give_the_rows_of_the_training_order(spark):
    """More shards than waves, fewer, one, and none: the files hold every sequence once, at its slot."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    docs = spark.createDataFrame([(i, f"text {i} " * (i % 9)) for i in range(60)], "doc_id long, text string")
    for rows, shard_rows in ((60, 4), (60, 30), (60, 1000), (0, 4)):
        some = docs.where(f"doc_id < {rows}")
        want = K.training_order(some, seq_len=8, shard_rows=shard_rows).collect()
        got = K.materialised(some, seq_len=8, shard_rows=shard_rows).collect()
        key = lambda r: r.slot
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
        assert [r.slot for r in sorted(got, key=key)] == list(range(len(got)))
    assert spark.conf.get(setting) == before
