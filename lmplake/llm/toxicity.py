"""Toxicity scores from non-negative positive-unlabelled learning.

Only confirmed toxic texts are taken as labelled; everything else is unlabelled, a mixture
with a share ``prior`` of toxic texts. A linear model over the presence of words is trained
in numpy on the driver with the class-prior-corrected risk

    prior * E+[l(g)] + max(0, E_u[l(-g)] - prior * E+[l(-g)])

l being the logistic loss: the risk of the negative class is what unlabelled texts show less
the share that the toxic ones among them cause. An estimate of it below zero is overfitting;
then a step goes the other way (up the second term), which is the non-negative estimator.

The training sample is bounded: about ``positives`` toxic and ``unlabelled`` other documents, chosen
by hash; words are counted over the sample in Spark, those that are significantly more frequent in toxic
texts (at most ``words``) are the features, and only their numbers in each sampled text come to the driver. The prior is the share
of toxic rows among labelled ones (they are a random cover); where only toxic ones are labelled, it is estimated from the
ten most telling words: how much rarer they are in unlabelled texts.

Scores cover whole texts: each word of the text that carries weight counts once.

Defined cases: a null or empty text has the score of the bias alone; null labels are not learned from;
a key whose labels contradict each other is toxic; without any toxic example, or without any text to learn
from, every score is 0. Extra columns pass through (``predict`` refuses one that is named like an output).
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lmplake.llm.common import free_name, map_arrow, u32, written

PIECE = 1 << 20  # characters of a text whose words are held at once
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    """Weights of words, bias, and the prior that the risk was corrected by."""
    weights: dict[str, float]
    bias: float
    prior: float


def pieces(text: str) -> Iterable[str]:
    """The text in slices of about ``PIECE`` characters that don't cut words."""
    a = 0
    while a < len(text):
        b = min(len(text), a + PIECE)
        while b < len(text) and text[b - 1].isalpha():
            b += 1
        yield text[a:b]
        a = b


def words_of(text: str | None, known: set | dict | None = None) -> set[str]:
    """Distinct lower-cased words of a whole text (those in ``known``, if given)."""
    out: set[str] = set()
    for part in pieces(text or ""):
        found = set(_WORD.findall(part.lower()))
        out |= found if known is None else found & known.keys()
    return out


# ---------------------------------------------------------------- risk

def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def risks(gp: np.ndarray, gu: np.ndarray, prior: float) -> tuple[float, float]:
    """Positive risk and (corrected, maybe negative) negative risk of the scores of both sides."""
    return float(prior * _softplus(-gp).mean()), float(_softplus(gu).mean() - prior * _softplus(gp).mean())


def risk_slopes(gp: np.ndarray, gu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of the step's objective by the scores: of the whole risk, or, where the
    negative risk is below zero, of that part with its sign turned."""
    up, uu = prior * _sigmoid(gp) / len(gp), _sigmoid(gu) / len(gu)
    if risks(gp, gu, prior)[1] < 0:
        return up, -uu
    return -prior * _sigmoid(-gp) / len(gp) - up, uu


def train(pos: list[np.ndarray], other: list[np.ndarray], n_words: int, prior: float, steps: int = 800, rate: float = 0.05,
          lasso: float = 0.03) -> tuple[np.ndarray, float]:
    """Weights and bias for texts given as arrays of word numbers: Adam over all texts in each step (estimates of
    the corrected risk from small batches fall below zero by chance), weights kept at or above 0 (the words were chosen
    for being more frequent in toxic texts), and a lasso step that takes words without evidence to exactly 0."""
    sides = [(np.repeat(np.arange(len(t)), [len(x) for x in t]), np.concatenate(t).astype(np.int64), len(t)) for t in (pos, other)]
    w, mean, var = (np.zeros(n_words + 1) for _ in range(3))
    w[-1] = np.log(prior / (1 - prior))
    for step in range(1, steps + 1):
        scores = [w[-1] + np.bincount(row, w[word], n) for row, word, n in sides]
        slopes = risk_slopes(*scores, prior)
        grad = np.append(sum(np.bincount(word, s[row], n_words) for s, (row, word, _) in zip(slopes, sides)), sum(s.sum() for s in slopes))
        mean += 0.1 * (grad - mean)
        var += 0.001 * (grad * grad - var)
        w -= rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(var / (1 - 0.999 ** step)) + 1e-8)
        w[:-1] = np.maximum(w[:-1] - rate * lasso, 0)
    return w[:-1], float(w[-1])


# ---------------------------------------------------------------- fit

def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, positives: int, unlabelled: int):
    """(toxic, words) of the sampled documents, written, and the prior."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("key")) \
        .agg(F.max(F.col(label).cast("int")).alias("toxic"))
    n_toxic, n_known = known.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    if not n_toxic:
        return None, None
    prior = n_toxic / n_known if n_known > n_toxic else None
    part = u32(F.lit("toxic"), F.col("key").cast("string")) < F.lit(int(min(1.0, positives / n_toxic) * (1 << 32)))
    chosen = known.where(F.col("toxic") == 1).where(part).select("key").limit(2 * positives)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    share = min(1.0, unlabelled / max(1, rows.count()))
    mark = u32(F.lit("unlabelled"), F.col("key").cast("string"), "text")
    taken = rows.join(F.broadcast(chosen), "key").withColumn("toxic", F.lit(1)).unionByName(
        rows.where(mark < F.lit(int(share * (1 << 32)))).withColumn("toxic", F.lit(0)))
    # copies of a row count once
    taken = taken.withColumn("u", F.xxhash64(F.col("key").cast("string"), "text")).dropDuplicates(["toxic", "u"])

    def run(batches):
        for b in batches:
            found = [sorted(words_of(t)) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.string()))], names=["toxic", "u", "words"])

    return written(map_arrow(taken.select("toxic", "u", "text"), run, "toxic int, u long, words array<string>"), "toxic-sample"), prior


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", positives: int = 4096,
        unlabelled: int = 16384, words: int = 2048, min_docs: int = 5,
        least_excess: float = 5.0, **options) -> Model | None:
    """Train on ``docs`` and the positive labels of ``labels`` (keys and labels, of documents that may be learned from)."""
    sample, prior = _sample(docs, labels, key, text, label, positives, unlabelled)
    if sample is None:
        return None
    sides = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(sides) < 2:
        return None
    n_pos, n_other = sides[1], sides[0]
    counts = sample.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("toxic").alias("pos"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs)
    # how far a word's toxic documents are above their expectation, in standard deviations (less half a document)
    rate = F.col("n") / F.lit(float(n_pos + n_other))
    spread = F.sqrt(F.greatest(rate * (1 - rate), F.lit(1e-12)) * F.lit(n_pos * (n_pos + n_other) / n_other))
    excess = (F.col("pos") - 0.5 - rate * n_pos) * F.lit((n_pos + n_other) / n_other) / spread
    telling = counts.withColumn("excess", excess).where(F.col("excess") >= least_excess)
    rows = telling.orderBy(F.col("excess").desc(), "word").limit(words).collect()
    best = [r["word"] for r in rows]
    if prior is None:  # words that only toxic texts use are in unlabelled ones by the prior less often
        prior = sum(r["n"] - r["pos"] for r in rows[:10]) / n_other * n_pos / max(1, sum(r["pos"] for r in rows[:10]))
    prior = min(max(prior, 1e-4), 0.9)
    number = {w: i for i, w in enumerate(best)}

    def run(batches):
        for b in batches:
            found = [[number[w] for w in row if w in number] for row in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "u", "words"])

    got = map_arrow(sample, run, "toxic int, u long, words array<int>").orderBy("toxic", "u").collect()
    side = lambda s: [np.array(r["words"], np.int64) for r in got if r["toxic"] == s]
    if not best:
        return Model({}, float(np.log(prior / (1 - prior))), prior)
    weights, bias = train(side(1), side(0), len(best), prior, **options)
    return Model({w: float(x) for w, x in zip(best, weights) if x != 0}, bias, prior)


def predict(docs: DataFrame, model: Model | None, text: str = "text", score_out: str = "score", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default: all) plus the score of the whole text, between 0 and 1."""
    carry = docs.columns if carry is None else carry
    if score_out in carry:
        raise ValueError(f"the input already has a column {score_out}; name another output")
    if model is None:
        return docs.select(*carry, F.lit(0.0).alias(score_out))
    fields = [docs.schema[c] for c in carry]

    def run(batches):
        for b in batches:
            g = [model.bias + sum(model.weights[w] for w in sorted(words_of(t, model.weights))) for t in b.column(len(fields)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(fields)], pa.array(_sigmoid(np.array(g)))], names=[*[f.name for f in fields], score_out])

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields] + [T.StructField(score_out, T.DoubleType())])
    source = docs.select(*carry, F.col(text).alias(free_name([*carry, score_out], "text")))
    return map_arrow(source, run, schema)
