"""Language identification with a byte convolutional network.

The network is trained in numpy on the driver, on a bounded sample of labelled
windows (``train_docs`` documents, ``windows_per_doc`` windows of ``window`` bytes
each, both parameters); filters of several widths slide over the bytes, each is
max-pooled over the window, and a softmax layer gives the language.

Prediction covers every byte of every text: a text is cut into consecutive
windows of fixed length (the last one is moved back to end with the text, a text
shorter than a window is padded with zero bytes), windows are classified in
batches, and a text's probabilities are the mean over its windows, weighted by
the bytes that each window adds. A filter of width w over one-hot bytes is a sum
of w table rows; tables of byte pairs halve the look-ups.

Defined cases: a null text or one without any letter is ``und`` with score 0;
labels that are null are not learned from; with no labelled row at all every text
is ``und``. Extra columns of the input pass through untouched (``predict`` refuses
one that is named like an output). Ties between languages go to the first in
code point order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmplake.llm.common import chunks, free_name, map_arrow, u32, utf8

UNDETERMINED = "und"
WIDTHS = (2, 3, 4)


@dataclass
class ByteCNN:
    """Filters [width, 256, n] per width, biases, dense layer, languages."""
    langs: list[str]
    window: int
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Look-up rows: first byte pair (all filters), third byte (width 3), second pair (width 4)."""
        f2, f3, f4 = (self.filters[w] for w in WIDTHS)
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        first = np.concatenate([pair(f2[0], f2[1]), pair(f3[0], f3[1]), pair(f4[0], f4[1])], axis=1)
        return (np.ascontiguousarray(first, np.float32), np.ascontiguousarray(f3[2], np.float32),
                np.ascontiguousarray(pair(f4[2], f4[3]), np.float32))


def pooled(model: ByteCNN, tables, x: np.ndarray) -> np.ndarray:
    """Max-pooled activations of windows x [m, window] (uint8)."""
    first, third, second = tables
    n = third.shape[1]
    m, w = x.shape
    pairs = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
    act = first[pairs[:, :w - 3]]
    act[:, :, n:2 * n] += third[x[:, 2:w - 1]]
    act[:, :, 2 * n:] += second[pairs[:, 2:]]
    return np.maximum(act.max(axis=1) + model.bias, 0)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, langs: list[str], n_filters: int = 8, epochs: int = 8,
          rate: float = 0.02, batch: int = 64, seed: int = 7) -> ByteCNN:
    """Adam on class-weighted cross-entropy; the max-pool passes the gradient to
    the winning position of each filter only, so updates are sparse."""
    rng = np.random.default_rng(seed)
    m, window = x.shape
    k, total = len(langs), n_filters * len(WIDTHS)
    flat = rng.normal(0, 0.1, (sum(WIDTHS) * 256, n_filters)).astype(np.float32)
    starts = dict(zip(WIDTHS, np.cumsum([0, *WIDTHS[:-1]]) * 256))
    params = [flat, np.zeros(total, np.float32), rng.normal(0, 0.1, (total, k)).astype(np.float32), np.zeros(k, np.float32)]
    mean, var = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def model() -> ByteCNN:
        f = {w: params[0][starts[w]:starts[w] + w * 256].reshape(w, 256, n_filters) for w in WIDTHS}
        return ByteCNN(langs, window, f, params[1], params[2], params[3])

    weight = (m / (k * np.maximum(np.bincount(y, minlength=k), 1)))[y].astype(np.float32)
    col = np.arange(n_filters)
    span = window - max(WIDTHS) + 1
    step = 0
    for _ in range(epochs):
        order = rng.permutation(m)
        for a in range(0, m, batch):
            rows = order[a:a + batch]
            xb, yb = x[rows].astype(np.int64), y[rows]
            f = model().filters
            acts = np.empty((len(rows), span, total), np.float32)
            for i, w in enumerate(WIDTHS):
                acts[:, :, i * n_filters:(i + 1) * n_filters] = sum(f[w][j][xb[:, j:j + span]] for j in range(w))
            top = acts.argmax(axis=1)
            z = np.take_along_axis(acts, top[:, None, :], 1)[:, 0] + params[1]
            h = np.maximum(z, 0)
            p = softmax(h @ params[2] + params[3])
            p[np.arange(len(rows)), yb] -= 1
            p *= (weight[rows] / len(rows))[:, None]
            gh = (p @ params[2].T) * (z > 0)
            gf = np.zeros_like(flat)
            for i, w in enumerate(WIDTHS):
                g, t = gh[:, i * n_filters:(i + 1) * n_filters], top[:, i * n_filters:(i + 1) * n_filters]
                for j in range(w):
                    byte = np.take_along_axis(xb, t + j, 1)
                    np.add.at(gf, (starts[w] + j * 256 + byte, col), g)
            step += 1
            for q, (param, grad) in enumerate(zip(params, (gf, gh.sum(0), h.T @ p, p.sum(0)))):
                mean[q] += 0.1 * (grad - mean[q])
                var[q] += 0.001 * (grad * grad - var[q])
                param -= rate * (mean[q] / (1 - 0.9 ** step)) / (np.sqrt(var[q] / (1 - 0.999 ** step)) + 1e-7)
    return model()


def windows_of(texts: list[bytes], window: int) -> np.ndarray:
    """One zero-padded window per byte string (strings are cut to the window)."""
    raw = b"".join(t[:window].ljust(window, b"\0") for t in texts)
    return np.frombuffer(raw, np.uint8).reshape(-1, window)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", window: int = 256,
        train_docs: int = 4096, windows_per_doc: int = 2, **options) -> ByteCNN | None:
    """Train on a sample of ``labelled``: the ``train_docs`` documents with the
    smallest key hash, ``windows_per_doc`` windows each, at hashed positions of the
    text. The sample is the whole bound; it doesn't grow with the table: rows beyond a
    hash that about four times the sample lies below are left out before anything is
    sorted, so the tasks send a bounded number of rows in all, not each of them a sample."""
    known = labelled.where(F.col(lang).isNotNull())
    share = min(1.0, 4 * train_docs / max(1, known.count()))
    rows = known.where(F.col(text).rlike(r"\p{L}"))
    sample = rows.select(F.col(lang).alias("lang"), F.col(key).alias("key"), F.col(text).alias("text"),
                         u32(F.lit("langid"), F.col(key).cast("string")).alias("u")) \
        .where(F.col("u") < F.lit(int(share * (1 << 32))))
    spots = [1 + F.floor(u32(F.lit(i), F.col("key").cast("string")) / F.lit(float(1 << 32))
                         * F.greatest(F.length("text") - F.lit(window * 3 // 4), F.lit(1))).cast("int")
             for i in range(windows_per_doc)]
    cut = sample.select("lang", "key", "u", *[F.substring(F.col("text"), s, F.lit(window)).alias(f"w{i}")
                                              for i, s in enumerate(spots)])
    got = cut.orderBy("u", "key", "lang", *[f"w{i}" for i in range(windows_per_doc)]).limit(train_docs).collect()
    if not got:
        return None
    langs = sorted({r["lang"] for r in got})
    texts = [(r[f"w{i}"] or "").encode() for r in got for i in range(windows_per_doc)]
    y = np.repeat([langs.index(r["lang"]) for r in got], windows_per_doc)
    return train(windows_of(texts, window), y, langs, **options)


def score_batch(model: ByteCNN, tables, raw: np.ndarray, offsets: np.ndarray, batch: int = 64) -> np.ndarray:
    """Probabilities [rows, languages] of whole texts; empty texts are uniform."""
    win, n = model.window, len(offsets) - 1
    size = np.diff(offsets)
    count = np.maximum(1, -(-size // win))
    row = np.repeat(np.arange(n), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(nth * win, np.maximum(size[row] - win, 0))
    weight = np.minimum(win, size[row] - nth * win).clip(0)
    padded = np.concatenate([raw, np.zeros(win, np.uint8)])
    at = offsets[row] + start
    keep = np.minimum(win, size[row])
    out = np.zeros((n, len(model.langs)))
    view = np.lib.stride_tricks.sliding_window_view(padded, win)
    for a in range(0, len(row), batch):
        x = view[at[a:a + batch]]
        short = keep[a:a + batch] < win
        if short.any():
            x[short] = np.where(np.arange(win) < keep[a:a + batch][short][:, None], x[short], 0)
        p = softmax(pooled(model, tables, x) @ model.dense + model.dense_bias)
        np.add.at(out, row[a:a + batch], p * weight[a:a + batch][:, None])
    total = out.sum(axis=1, keepdims=True)
    return np.where(total > 0, out / np.maximum(total, 1e-300), 1 / len(model.langs))


def predict(docs: DataFrame, model: ByteCNN | None, text: str = "text", lang_out: str = "lang_pred",
            score_out: str = "score", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default: all) plus the predicted language and its probability."""
    carry = docs.columns if carry is None else carry
    clash = {lang_out, score_out} & set(carry)
    if clash:
        raise ValueError(f"the input already has columns {sorted(clash)}; name other outputs")
    if model is None:
        return docs.select(*carry, F.lit(UNDETERMINED).alias(lang_out), F.lit(0.0).alias(score_out))
    fields = [docs.schema[c] for c in carry]
    src = docs.select(*[F.col(c) for c in carry], F.col(text).alias(free_name(carry, "_text")),
                      F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias(free_name(carry, "_letters")))

    def run(batches):
        tables = model.tables()
        langs = np.array([*model.langs, UNDETERMINED], dtype=object)
        for b in batches:
            raw, offs = utf8(b.column(len(fields)))
            has = np.asarray(b.column(len(fields) + 1).to_pylist(), bool)
            best, prob = np.zeros(len(has), np.int64), np.zeros(len(has))
            for i, j in chunks(offs):
                p = score_batch(model, tables, raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                best[i:j] = p.argmax(axis=1)
                prob[i:j] = p[np.arange(j - i), best[i:j]]
            best[~has], prob[~has] = len(model.langs), 0.0
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(fields)], pa.array(langs[best].tolist(), pa.string()), pa.array(prob)],
                names=[*[f.name for f in fields], lang_out, score_out])

    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields]
                          + [T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())])
    return map_arrow(src, run, schema)


def held_out(key: str = "doc_id", folds: int = 5):
    """True for the fold that is never learned from: crc32 of the key's text."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(False))
