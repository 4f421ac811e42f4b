import random
import zlib

import numpy as np
import pytest

from lmplake.llm import langid as L

SYL = {"aa": "ka lo mi tu ne".split(), "bb": "sch ung ber zen ö".split(), "cc": "eau que oux é tion".split()}


def docs(n=240, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYL))
        words = ["".join(rng.choice(SYL[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(4, 150))]
        rows.append((i, " ".join(words), lang if rng.random() < 0.9 else None, "x"))
    return rows


def test_held_out_accuracy_and_defined_cases(frame):
    rows = docs() + [(900, None, "aa", ""), (901, "", "aa", ""), (902, "123 !? 4", "aa", ""), (None, "schung berzen", "bb", ""),
                     (903, "kalo mitu " * 20_000, "aa", ""), (904, "kalo", None, ""), (904, "kalo", None, "")]
    df = frame(rows, "doc_id long, text string, lang string, extra string").withColumn("held_out", L.held_out())
    model = L.fit(df.where("not held_out"), epochs=6)
    out = L.predict(df, model, carry=["doc_id", "held_out", "lang", "text"]).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
    judged = [r for r in out if r["held_out"] and r["lang"] and r["lang_pred"] != "und"]
    assert sum(r["lang"] == r["lang_pred"] for r in judged) >= 0.95 * len(judged) > 0


def test_prediction_covers_the_whole_text():
    model = L.train(*_windows(), epochs=6)
    t = model.tables()
    raw = ("kalo " * 100 + "schung " * 2000).encode()
    p = L.score_batch(model, t, np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert model.langs[int(p[0].argmax())] == "bb"
    assert p.sum() == pytest.approx(1)


def _windows():
    rows = [(t, lang) for _, t, lang, _ in docs(seed=9) if lang]
    langs = sorted({lang for _, lang in rows})
    return L.windows_of([t.encode() for t, _ in rows], 256), np.array([langs.index(x) for _, x in rows]), langs


def test_tables_equal_the_convolution():
    model = L.train(*_windows(), epochs=1)
    x = _windows()[0][:5]
    got = L.pooled(model, model.tables(), x)
    span = x.shape[1] - 3
    want = np.concatenate([sum(model.filters[w][j][x[:, j:j + span]] for j in range(w)).max(axis=1) for w in L.WIDTHS], axis=1)
    assert np.allclose(got, np.maximum(want + model.bias, 0), atol=1e-4)


def test_no_labels_empty_table_and_clash(frame):
    schema = "doc_id long, text string, lang string"
    df = frame([(1, "kalo", None)], schema)
    assert L.fit(df) is None
    assert [(r["lang_pred"], r["score"]) for r in L.predict(df, None).collect()] == [("und", 0.0)]
    assert L.predict(frame([], schema), None).collect() == []
    with pytest.raises(ValueError):
        L.predict(df, None, lang_out="lang")
