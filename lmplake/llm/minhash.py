"""Near-duplicate documents by DartMinHash signatures and banded joining.

A document is a weighted set: its shingles of five lower-cased words, weighted by
how often they occur (a text of one to four words is one shingle). Similarity is
the weighted Jaccard similarity, sum of minima over sum of maxima.

Signature: every element i of weight x owns the region [0, x) of a weight axis,
and darts fall on (element, weight, rank) as a unit-rate Poisson process that
depends only on hashes, so all documents see the same darts. A document throws
the darts of its own regions up to rank t/|x| (about t = k ln k + 2k of them),
each dart is hashed to one of k coordinates, and the dart of least rank stays per
coordinate. Two documents agree on a coordinate with a probability equal to their
similarity. Documents with an empty coordinate throw again with twice the rank.

Joining: exact copies count once (one representative for each text). Signatures
are cut into bands. In each band bucket the signatures are compared, and the
documents whose agreement is not far below the threshold (``MARGIN`` standard
deviations) are joined to clumps. Inside a clump all texts are compared exactly,
on shingle counts; links are the pairs at or above the threshold, classes their
connected components. Comparisons are matrix operations inside a task that only
give out a spanning forest, so no list of pairs exists. Buckets and clumps beyond
``BLOCK_ROWS`` rows or ``BLOCK_BYTES`` bytes are cut into blocks, one task group
for each pair of blocks, so a group of a third of all rows is spread over many
tasks and no pair of it is left out.

Defined cases: null texts, empty texts and texts without a word are similar to
nothing and stay their own class, also among each other. Rows with the same key
are one document; a null key never links and has a null class. Empty tables give
empty results. Columns besides key and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmplake.llm.common import U64, chunks, map_arrow, mix, settled, utf8, word_hash, words, written
from lmplake.llm.graph import components

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 6
MARGIN = 4.5
BLOCK_ROWS = 2048
BLOCK_BYTES = 16 << 20
_M = U64(0x9FB21C651E98DF25)


def shingles(raw: np.ndarray, offsets: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row: rows, 64-bit shingle hashes and their counts,
    ordered by row, then hash."""
    s, e, row = words(raw, offsets)
    if not len(s):
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64)
    h = word_hash(raw, s, e)
    per_row = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(per_row) - per_row
    m = len(h)
    whole = np.zeros(m, U64)
    for j in range(n):  # the words j after, where they are in the same row
        at = np.arange(m) + j
        inside = at < (first + per_row)[row]
        nxt = np.where(inside, h[np.minimum(at, m - 1)], U64(0x51))
        whole = (whole + nxt) * _M + U64(j)
    pos = np.arange(m) - first[row]
    keep = (pos + n <= per_row[row]) | (pos == 0)
    row, g = row[keep], mix(whole[keep])
    # one sort by (row, leading hash bits); rows of a chunk need about 20 bits
    shift = U64(max(1, int(len(offsets)).bit_length()))
    order = np.argsort((row.astype(U64) << (U64(64) - shift)) | (g >> shift))
    row, g = row[order], g[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return row[at], g[at], np.diff(np.append(at, len(g)))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> U64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def dart_minhash(row: np.ndarray, item: np.ndarray, weight: np.ndarray, n_rows: int, k: int) -> np.ndarray:
    """Signatures [n_rows, k] (uint64) of weighted sets given as sorted triples;
    rows without an element get zeros."""
    out = np.zeros((n_rows, k), U64)
    total = np.bincount(row, weights=weight, minlength=n_rows)
    bound = np.where(total > 0, (k * np.log(k) + 2 * k) / np.maximum(total, 1), 0)
    live = np.arange(len(row))
    while len(live):
        best = np.full(n_rows * k, np.inf)
        found = []
        strip = 0
        part = live
        while len(part):  # strips of the weight axis: [0,1), [1,2), [2,4), [4,8), ...
            low = 0.0 if strip == 0 else 2.0 ** (strip - 1)
            width = 1.0 if strip == 0 else low
            part = part[weight[part] > low]
            at, rank = part, np.zeros(len(part))
            seed = mix(item[at] + U64((strip + 1) * 0xA0761D6478BD642F % 2**64))
            nth = 0
            while len(at):  # the arrivals of each strip, in rank order
                nth += 1
                h = mix(seed + U64(nth * 0xE7037ED1A0B428DB % 2**64))
                rank = rank - np.log(_uniform(h)) / width
                go = rank <= bound[row[at]]
                at, seed, rank, h = at[go], seed[go], rank[go], h[go]
                spot = mix(h ^ U64(0x8EBC6AF09C88C6E3))
                hit = (low + width * _uniform(spot) < weight[at]) if strip else np.ones(len(at), bool)
                dart = mix(spot ^ h)
                key = row[at][hit] * k + (dart[hit] % U64(k)).astype(np.int64)
                found.append((key, rank[hit], dart[hit]))
            strip += 1
        key, rank, dart = (np.concatenate(x) for x in zip(*found))
        np.minimum.at(best, key, rank)
        win = rank == best[key]
        got = np.zeros(n_rows * k, U64)
        got[key[win]] = dart[win]
        rows = np.unique(row[live])
        full = np.isfinite(best).reshape(n_rows, k)[rows].all(axis=1)
        out[rows[full]] = got.reshape(n_rows, k)[rows[full]]
        bound[rows[~full]] *= 2
        again = np.zeros(n_rows, bool)
        again[rows[~full]] = True
        live = live[again[row[live]]]
    return out


def signatures(docs: DataFrame, key: str, text: str, bands: int, rows: int) -> DataFrame:
    """(key, size, digest, sig, bands): bytes and SHA-256 of the lower-cased text, one
    byte of each coordinate, and one hash for each band of the signature (both null for
    texts without a word)."""
    lower = F.lower(F.col(text))
    src = docs.select(F.col(key).alias("_key"), lower.alias("_text"), F.unhex(F.sha2(lower, 256)).alias("_digest"))
    kind = src.schema["_key"].dataType.simpleString()

    def run(batches):
        for b in batches:
            raw, offs = utf8(b.column(1))
            n = len(offs) - 1
            sig, some = np.zeros((n, bands), U64), np.zeros(n, bool)
            low = np.zeros((n, bands * rows), np.uint8)
            for i, j in chunks(offs):
                part, o = raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
                r, g, c = shingles(part, o)
                d = dart_minhash(r, g, c.astype(np.float64), j - i, bands * rows).reshape(j - i, bands, rows)
                v = np.zeros((j - i, bands), U64) + np.arange(1, bands + 1, dtype=U64)
                for q in range(rows):
                    v = mix(v * _M + d[:, :, q])
                sig[i:j] = v
                low[i:j] = d.reshape(j - i, -1) >> U64(56)
                some[i:j] = np.bincount(r, minlength=j - i) > 0
            arr = pa.FixedSizeListArray.from_arrays(pa.array(sig.view(np.int64).ravel()), bands).cast(pa.list_(pa.int64()))
            arr = pc.if_else(pa.array(some), arr, pa.nulls(n, arr.type))
            code = pa.FixedSizeBinaryArray.from_buffers(pa.binary(bands * rows), n, [None, pa.py_buffer(low)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(offs)), b.column(2), pc.if_else(pa.array(some), code, pa.nulls(n, code.type)), arr],
                names=["key", "size", "digest", "sig", "bands"])

    return map_arrow(src, run, f"key {kind}, size bigint, digest binary, sig binary, bands array<bigint>")


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    left = np.ones(len(linked), bool)
    a, b = [], []
    for i in range(len(linked)):
        if not left[i]:
            continue
        left[i] = False
        front = np.array([i])
        while len(front):
            reach = linked[front].any(axis=0) & left
            front = np.flatnonzero(reach)
            left[front] = False
            a.append(np.full(len(front), i))
            b.append(front)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, int), np.zeros(0, int))


def agreement(sig: np.ndarray, least: int) -> np.ndarray:
    """Which rows of one-byte signatures agree on at least ``least`` coordinates."""
    n, k = sig.shape
    same = np.zeros((n, n), np.uint16)
    for c in range(k):
        col = np.ascontiguousarray(sig[:, c])
        same += col[:, None] == col[None, :]
    return same >= least


def similar(row: np.ndarray, item: np.ndarray, count: np.ndarray, n: int, threshold: float, width: int = 2048) -> np.ndarray:
    """Which of n weighted sets have a weighted Jaccard similarity of at least
    ``threshold``: the overlaps are products of 0/1 matrices (a shingle that occurs
    c times is c items), made over ``width`` shared items at a time."""
    total = np.bincount(row, weights=count, minlength=n)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    row = np.repeat(row, count)
    item = mix(np.repeat(item, count) + nth.astype(U64) * _M)
    order = np.argsort(item)
    row, item = row[order], item[order]
    new = np.ones(len(item), bool)
    new[1:] = item[1:] != item[:-1]
    which = np.cumsum(new) - 1
    shared = np.bincount(which)[which] > 1
    row, which = row[shared], which[shared]
    which = np.cumsum(np.append(0, np.diff(which) > 0)) if len(which) else which
    both = np.zeros((n, n), np.float32)
    for a in range(0, int(which[-1]) + 1 if len(which) else 0, width):
        i, j = np.searchsorted(which, [a, a + width])
        m = np.zeros((n, width), np.float32)
        m[row[i:j], which[i:j] - a] = 1
        both += m @ m.T
    union = total[:, None] + total[None, :] - both
    return both >= threshold * union - 1e-6


def blocks(df: DataFrame, group: str, sizes: DataFrame) -> DataFrame:
    """Deal the rows (group, key, ...) of each group into pairs of blocks (lo, hi).
    ``sizes`` has (group, n, bytes); groups within the limits are one block."""
    parts = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    cut = df.join(sizes.select(group, parts.alias("parts")), group)         .withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))         .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return cut.withColumn("lo", F.least("chunk", "other")).withColumn("hi", F.greatest("chunk", "other")) \
        .drop("parts", "other", "chunk").repartition(group, "lo", "hi").sortWithinPartitions(group, "lo", "hi", "key")


def grouped(batches, n_group: int = 3):
    """Batches cut so that no group (the first ``n_group`` columns, sorted) is split,
    with the groups' starts."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
        if not t.num_rows:
            continue
        t = t.combine_chunks()
        change = np.zeros(t.num_rows, bool)
        change[0] = True
        for c in range(n_group):
            v = t.column(c).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        starts = np.flatnonzero(change)
        if len(starts) > 1:
            yield t.slice(0, starts[-1]).combine_chunks(), starts
        rest = t.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), np.array([0, rest.num_rows])


def clumps(bucketed: DataFrame, sizes: DataFrame, k: int, threshold: float) -> DataFrame:
    """(a, b): spanning forests of the documents that agree well enough in their buckets."""
    kind = bucketed.schema["key"].dataType.simpleString()
    least = max(1, int(np.ceil(k * (threshold - MARGIN * np.sqrt(threshold * (1 - threshold) / k)))))

    def run(batches):
        for t, starts in grouped(batches):
            sig = np.frombuffer(utf8(t.column("sig"))[0], np.uint8).reshape(-1, k)
            size = np.diff(starts)
            two = starts[:-1][size == 2]
            two = two[(sig[two] == sig[two + 1]).sum(axis=1) >= least]
            a, b = [two], [two + 1]
            for s, n in zip(starts[:-1][size > 2], size[size > 2]):
                x, y = forest(agreement(sig[s:s + n], least))
                a.append(s + x)
                b.append(s + y)
            key = t.column("key").combine_chunks()
            yield pa.RecordBatch.from_arrays([key.take(pa.array(np.concatenate(a))), key.take(pa.array(np.concatenate(b)))],
                                             names=["a", "b"])

    rows = blocks(bucketed, "hash", sizes).select("hash", "lo", "hi", "key", "sig")
    return map_arrow(rows, run, f"a {kind}, b {kind}")


def exact_links(members: DataFrame, sizes: DataFrame, docs: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    """(a, b): spanning forests of the links inside each clump, on exact shingle counts."""
    kind = members.schema["key"].dataType.simpleString()
    texts = docs.select(F.col(key).alias("key"), F.lower(F.col(text)).alias("text"))
    one = members.join(texts, "key").withColumn("x", F.xxhash64("text")).dropDuplicates(["key", "clump", "x"])
    rows = blocks(one, "clump", sizes).select("clump", "lo", "hi", "key", "text")

    def run(batches):
        for t, starts in grouped(batches):
            key_col = t.column("key").combine_chunks()
            raw, offs = utf8(t.column("text"))
            a, b = [], []
            for s, e in zip(starts[:-1], starts[1:]):
                r, g, c = shingles(raw[offs[s]:offs[e]], offs[s:e + 1] - offs[s])
                x, y = forest(similar(r, g, c, e - s, threshold))
                a.append(s + x)
                b.append(s + y)
            yield pa.RecordBatch.from_arrays([key_col.take(pa.array(np.concatenate(a))),
                                              key_col.take(pa.array(np.concatenate(b)))], names=["a", "b"])

    return map_arrow(rows, run, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row for each row of ``docs``: key, class_id (the smallest key of its
    group), kept (key = class_id; a row with a null key has no class and is kept)."""
    return settled(docs.sparkSession, lambda: _classes(docs, key, text, threshold, bands, rows), "classes")


def _classes(docs: DataFrame, key: str, text: str, threshold: float, bands: int, rows: int) -> DataFrame:
    sig = written(signatures(docs, key, text, bands, rows), "signatures")
    some = sig.where("key is not null and bands is not null")
    # one representative for each text
    texts = written(some.groupBy("digest").agg(F.min("key").alias("key"), F.min("size").alias("size"),
                                                 F.min("bands").alias("bands"), F.min("sig").alias("sig")), "texts")
    member = texts.select("key", F.explode("bands").alias("hash"))
    sizes = member.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1") \
        .select("hash", "n", F.col("n").alias("bytes"))
    bucketed = member.join(sizes.select("hash"), "hash", "left_semi").distinct().join(texts.select("key", "sig"), "key")
    near = components(clumps(bucketed, sizes, bands * rows, threshold), "a", "b")
    members = near.select(F.col("node").alias("key"), F.col("component").alias("clump"))
    clump_sizes = members.join(texts.select("key", "size"), "key").groupBy("clump") \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    group = components(exact_links(members, clump_sizes, docs, key, text, threshold), "a", "b")
    out = sig.select("key", "digest", F.col("bands").isNotNull().alias("some")) \
        .join(texts.select("digest", F.col("key").alias("rep")), "digest", "left") \
        .withColumn("rep", F.when(F.col("key").isNotNull() & F.col("some"), F.col("rep")).otherwise(F.col("key"))) \
        .join(group.select(F.col("node").alias("rep"), "component"), "rep", "left")
    return out.select(F.col("key").alias(key), F.coalesce("component", "rep").alias("class_id")) \
        .withColumn("kept", F.col(key).isNull() | (F.col(key) == F.col("class_id")))
