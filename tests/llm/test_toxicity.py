import random
import zlib

import numpy as np
import pytest

from lmplake.llm import queries as Q
from lmplake.llm import toxicity as T

DOCS = "doc_id long, text string, score_text string"


def corpus(n=900, seed=2):
    rng = random.Random(seed)
    plain = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(300)]
    bad = ["vile", "rotten", "swine"]
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.12
        words = [rng.choice(plain) for _ in range(rng.randrange(3, 120))]
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(bad))
        docs.append((i, " ".join(words).title() + ".", "x"))
        if rng.random() < 0.5:
            labels.append((i, int(toxic)))
    return docs, labels, {i for i, t, _ in docs if any(b in t.lower() for b in bad)}


def test_slopes_are_those_of_the_risk():
    rng = np.random.default_rng(1)
    for shift in (0.0, 6.0):  # with the second, the corrected negative risk is below zero
        gp, gu = rng.normal(shift, 1, 7), rng.normal(-shift, 1, 9)
        positive, negative = T.risks(gp, gu, 0.4)
        assert (negative < 0) == (shift > 0)
        assert positive == pytest.approx(0.4 * np.mean(np.log1p(np.exp(-gp))))
        assert negative == pytest.approx(np.mean(np.log1p(np.exp(gu))) - 0.4 * np.mean(np.log1p(np.exp(gp))))

        def aim(p, u):
            a, b = T.risks(p, u, 0.4)
            return a + b if negative >= 0 else -b

        sp, su = T.risk_slopes(gp, gu, 0.4)
        for i in range(7):
            step = np.eye(7)[i] * 1e-6
            assert sp[i] == pytest.approx((aim(gp + step, gu) - aim(gp - step, gu)) / 2e-6, abs=1e-6)
        for i in range(9):
            step = np.eye(9)[i] * 1e-6
            assert su[i] == pytest.approx((aim(gp, gu + step) - aim(gp, gu - step)) / 2e-6, abs=1e-6)


@pytest.mark.parametrize("negatives", [True, False])
def test_held_out_documents_are_told_apart(frame, negatives):
    docs, labels, toxic = corpus()
    long = [(2000, "wabx " * 300_000 + "vile", "x"), (2001, "wabx " * 300_000, "x"), (2002, None, "x"), (2003, "", "x"), (None, "rotten swine", "x"),
            (2004, "12 !?", "x")]
    if not negatives:
        labels = [r for r in labels if r[1] == 1]
    allowed = [r for r in labels if zlib.crc32(str(r[0]).encode()) % 4 != 2] + [(None, 1), (7, None)]
    model = T.fit(frame([d for d in docs if zlib.crc32(str(d[0]).encode()) % 4 != 2], DOCS), frame(allowed, "doc_id long, toxic int"))
    out = T.predict(frame(docs + long, DOCS), model).collect()
    assert len(out) == len(docs) + len(long) and out[0].__fields__ == ["doc_id", "text", "score_text", "score"]
    score = {r["doc_id"]: r["score"] for r in out}
    assert all(0 <= x <= 1 for x in score.values())
    held = [i for i, *_ in docs if zlib.crc32(str(i).encode()) % 4 == 2]
    hits = [score[i] >= Q.TOXIC_AT for i in held if i in toxic]
    false = [score[i] >= Q.TOXIC_AT for i in held if i not in toxic]
    assert np.mean(hits) >= 0.95 and np.mean(false) <= 0.02
    assert score[2000] >= 0.3 > score[2001] and score[None] >= 0.3
    assert score[2002] == score[2003] == score[2004] < 0.3


def test_held_out_labels_change_nothing(spark, frame, tmp_path):
    docs, labels, _ = corpus(300, 5)
    for name, flip in (("a", False), ("b", True)):
        frame(docs, DOCS).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        rows = [(i, 1 - t if flip and zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
        frame(rows, "doc_id long, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    a, b = (sorted(map(tuple, Q.op12_toxicity(spark, f"{tmp_path}/{n}").collect())) for n in "ab")
    assert a == b and all(h == (zlib.crc32(str(i).encode()) % 4 == 2) and p == int(s >= 0.3) for i, h, s, p in a)


def test_nothing_to_learn_from(frame):
    docs = frame([(1, "a", "")], DOCS)
    labels = frame([(1, 0), (2, None)], "doc_id long, toxic int")
    assert T.fit(docs, labels) is None
    assert T.fit(frame([], DOCS), frame([(1, 1)], "doc_id long, toxic int")) is None
    assert [r["score"] for r in T.predict(docs, None).collect()] == [0.0]
    assert T.predict(frame([], DOCS), T.Model({"a": 1.0}, 0.0, 0.1)).collect() == []
    with pytest.raises(ValueError):
        T.predict(docs, None, score_out="doc_id")


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(T, "PIECE", 5)
    assert T.words_of("Some unusually LONG words, é1b") == {"some", "unusually", "long", "words", "é", "b"}
