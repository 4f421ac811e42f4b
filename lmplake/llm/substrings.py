"""Exact removal of repeated substrings with suffix arrays.

A byte goes when a string of ``length`` (100) bytes covers it that also starts earlier: in
a document with a smaller key, or in the same document at a smaller start. Strings are
judged on the input; matches never cross documents.

Suffix arrays of content shards: equal strings must meet in one shard, without moving
every suffix of the corpus. Each window of ``length`` bytes is handed to its anchor, the
leftmost k-mer of least hash in it; equal windows have equal anchors. An anchor owns a
run of neighbouring windows, its context is the bytes that they cover, and there are
about 40 windows to an anchor. Only (anchor hash, context hash, document, place) is
shuffled, by anchor hash:

* a context that is alone with its anchor hash has no equal window anywhere;
* equal contexts (whole copies, mostly) are one context, standing at its earliest place:
  the windows of the others all start earlier there. They are collapsed in the tasks
  that read the documents already, so a group of copies isn't sent to one task;
* what is left, different contexts with one anchor, is a few hundredths of the text. Its
  bytes are fetched, dealt to content shards by anchor hash, and every shard is sorted by
  external induced sorting (``induced``): queues that spill to disk carry suffix tuples and
  common prefixes, so a shard may be larger than memory. A window is repeated when a
  suffix with a common prefix of ``length`` or more stands earlier.

Removed runs then go to their documents, which are cut and digested in one more pass.

Defined cases: a null text is empty; a text shorter than ``length`` loses nothing; texts
are taken in segments of ``SEGMENT`` windows, so a very long one needs no more memory;
rows that repeat a key with the same text get the same result (neither is earlier); rows
that repeat a key with another text are told apart by a 16-bit digest of the text; a
null key comes after all others. Extra columns are ignored, empty tables give no row.
Hashes have 64 bits and stand for equality of anchors and whole contexts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmplake.llm.common import U64, _BYTE_VALUES, chunks, map_arrow, mix, numbered, prefix_hash, prepare, span_hash, utf8, written
from lmplake.llm.induced import earliest_equal

LENGTH = 100
SEGMENT = 1 << 21
SHARD_BYTES = 2 << 20
LAST = (1 << 63) - 1
_BASE = 0xD1342543DE82EF95
_PLACE = U64((1 << 24) - 1)


def kmer_hashes(raw: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes of all k-mers, by doubling."""
    h, size = _BYTE_VALUES[raw], 1
    out, have = None, 0
    while True:
        if k & size:
            if out is None:
                out, have = h, size
            else:
                n = len(raw) - have - size + 1
                out = out[:n] * U64(pow(_BASE, size, 1 << 64)) + h[have:have + n]
                have += size
        if 2 * size > k:
            return out[:len(raw) - k + 1]
        n = len(raw) - 2 * size + 1
        h = h[:n] * U64(pow(_BASE, size, 1 << 64)) + h[size:size + n]
        size *= 2


def anchors(raw: np.ndarray, offs: np.ndarray, length: int):
    """(row, first window, windows, anchor hash, context hash) of each anchor's run."""
    k = max(1, length // 5)
    w = length - k + 1
    n = len(raw)
    empty = np.zeros(0, np.int64)
    if n < length:
        return empty, empty, empty, np.zeros(0, U64), np.zeros(0, U64)
    h = mix(kmer_hashes(raw, k))
    m = len(h)
    pad = -m % w
    place = np.arange(m + pad, dtype=U64)
    value = np.concatenate([h, np.full(pad, ~U64(0))]) & ~_PLACE | place
    grid = value.reshape(-1, w)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = m - w + 1  # windows
    anchor = (np.minimum(after[:count], before[w - 1:w - 1 + count]) & _PLACE).astype(np.int64)
    room = np.maximum(np.diff(offs) - length + 1, 0)
    rows = np.flatnonzero(room)
    ok = np.zeros(count + 1, np.int8)  # windows that don't cross a row's end
    np.add.at(ok, offs[rows], 1)
    np.add.at(ok, offs[rows] + room[rows], -1)
    ok = np.cumsum(ok[:-1]).astype(bool)
    head = ok.copy()
    head[1:] &= (anchor[1:] != anchor[:-1]) | ~ok[:-1]
    s = np.flatnonzero(head)
    stop = ok.copy()
    stop[:-1] &= (anchor[1:] != anchor[:-1]) | ~ok[1:]
    e = np.flatnonzero(stop)
    a = anchor[s]
    context = mix(span_hash(prefix_hash(raw), s, e + length) + (a - s).astype(U64))
    row = np.searchsorted(offs, s, side="right") - 1
    return row, s - offs[row], e - s + 1, h[a], context


def pieces(raw: np.ndarray, offs: np.ndarray, length: int):
    """``anchors`` over a batch, in bounded steps; rows and places refer to the batch."""
    for i, j in chunks(offs, SEGMENT):
        if j - i == 1 and offs[j] - offs[i] > 2 * SEGMENT:
            for a in range(int(offs[i]), max(int(offs[j]) - length + 1, int(offs[i]) + 1), SEGMENT):
                b = min(a + SEGMENT + length - 1, int(offs[j]))
                row, s, n, h, c = anchors(raw[a:b], np.array([0, b - a]), length)
                yield row + i, s + (a - int(offs[i])), n, h, c
        else:
            row, s, n, h, c = anchors(raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i], length)
            yield row + i, s, n, h, c


def _pack(start: np.ndarray, n: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """start (40 bits), number of windows (less 1, 7 bits), digest of the text (16 bits)."""
    return start << 23 | (n - 1) << 16 | digest


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("doc"), t.alias("text"),
                       F.xxhash64(t).bitwiseAND(F.lit(0xFFFF)).cast("int").alias("digest"))


def find_runs(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """(doc, place): runs of windows that also start earlier, packed."""
    keyed = _keyed(docs, key, text)

    def read(batches):
        for b in batches:
            raw, offs = utf8(b.column(1))
            doc, digest = (b.column(c).to_numpy().astype(np.int64) for c in (0, 2))
            got = [x for x in pieces(raw, offs, length)]
            row, s, n, h, c = (np.concatenate([g[q] for g in got]) if got else np.zeros(0, np.int64) for q in range(5))
            place = _pack(s, n, digest[row]) if len(row) else np.zeros(0, np.int64)
            doc = doc[row]
            # equal contexts of this batch: all but the earliest are repeated
            order = np.lexsort((place, doc))
            order = order[np.argsort(c[order].astype(U64), kind="stable")]
            again = np.zeros(len(order), bool)
            if len(order):
                again[order[1:]] = c[order[1:]] == c[order[:-1]]
                first = order[np.maximum.accumulate(np.where(again[order], 0, np.arange(len(order))))]
                same = np.zeros(len(order), bool)  # the same place in a repeated row: not earlier
                same[order] = (doc[order] == doc[first]) & (place[order] >> 16 == place[first] >> 16)
                again &= ~same
            # repeated runs are spread at random, they only pass through the shuffle
            spread = np.where(again, mix((doc * 31 + place).astype(U64)), h.astype(U64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(spread.view(np.int64)), pa.array(np.where(again, 0, c.astype(U64)).view(np.int64)),
                 pa.array(doc), pa.array(place), pa.array(again)],
                names=["anchor", "context", "doc", "place", "again"])

    found = map_arrow(keyed, read, "anchor bigint, context bigint, doc bigint, place bigint, again boolean") \
        .repartition("anchor").sortWithinPartitions("anchor", "context", "doc", "place")

    def meet(batches):
        """Passes repeated runs on; marks equal contexts as repeated; keeps the first of each
        context whose anchor has several contexts. State: the last row, and whether it waits."""
        last = None  # anchor, context, doc, place of the first of its context
        waiting = False  # that context is the anchor's first one so far
        names = ["anchor", "doc", "place", "again"]
        for b in batches:
            anchor, context, doc, place = (b.column(i).to_numpy() for i in range(4))
            again = np.asarray(b.column(4).to_numpy(zero_copy_only=False), bool)
            out = [(anchor[again], doc[again], place[again], np.ones(int(again.sum()), bool))]
            anchor, context, doc, place = (x[~again] for x in (anchor, context, doc, place))
            if len(anchor):
                if last is not None:
                    anchor, context, doc, place = (np.append(v, x) for v, x in zip(last, (anchor, context, doc, place)))
                new_a = np.append(True, anchor[1:] != anchor[:-1])
                new_c = new_a | np.append(True, context[1:] != context[:-1])
                first = np.maximum.accumulate(np.where(new_c, np.arange(len(anchor)), 0))
                later = ~new_c & ~((doc == doc[first]) & (place >> 16 == place[first] >> 16))
                out.append((anchor[later], doc[later], place[later], np.ones(int(later.sum()), bool)))
                group = np.cumsum(new_a) - 1
                several = np.bincount(group, weights=new_c)[group] > 1
                if last is not None and not waiting:  # the carried context has been given out
                    several |= group == 0
                give = new_c & several
                if last is not None and not waiting:
                    give[0] = False
                out.append((anchor[give], doc[give], place[give], np.zeros(int(give.sum()), bool)))
                tail = first[-1]
                waiting = not (give[tail] or (tail == 0 and last is not None and not waiting))
                last = (anchor[tail:tail + 1], context[tail:tail + 1], doc[tail:tail + 1], place[tail:tail + 1])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[i] for o in out])) for i in range(4)], names=names)

    met = written(map_arrow(found, meet, "anchor bigint, doc bigint, place bigint, again boolean"), "met")
    repeated = met.where("again").select("doc", "place")
    return repeated.unionByName(_sorted_runs(met.where("not again"), keyed, length))


def _sorted_runs(asked: DataFrame, keyed: DataFrame, length: int) -> DataFrame:
    """(doc, place) of repeated windows among contexts that share an anchor, by suffix sorting."""
    want = asked.withColumn("digest", F.col("place").bitwiseAND(F.lit(0xFFFF)).cast("int")) \
        .groupBy("doc", "digest").agg(F.collect_list(F.struct("anchor", "place")).alias("want"))

    def fetch(batches):
        for b in batches:
            raw, offs = utf8(b.column(1))
            want = b.column(2)
            count = np.diff(want.offsets.to_numpy())
            flat = want.flatten()
            place = flat.field("place").to_numpy()
            row = np.repeat(np.arange(len(count)), count)
            for a in range(0, len(place), 1 << 16):
                p, r = place[a:a + (1 << 16)], row[a:a + (1 << 16)]
                s = offs[r] + (p >> 23)
                size = (p >> 16 & 127) + length
                ends = np.append(0, np.cumsum(size))
                data = raw[np.arange(int(ends[-1])) + np.repeat(s - ends[:-1], size)]
                body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(p), [None, pa.py_buffer(ends), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays(
                    [flat.field("anchor").slice(a, 1 << 16), b.column(0).take(pa.array(r)), pa.array(p), body.cast(pa.binary())],
                    names=["anchor", "doc", "place", "bytes"])

    fetched = keyed.join(want, ["doc", "digest"]).select("doc", "text", "want")
    contexts = map_arrow(fetched, fetch, "anchor bigint, doc bigint, place bigint, bytes binary") \
        .dropDuplicates(["anchor", "doc", "place"]) \
        .repartition("anchor").sortWithinPartitions("anchor")

    def sort(batches):
        held, size = [], 0

        def done(t: pa.Table) -> pa.RecordBatch:
            doc, place = t.column("doc").to_numpy(), t.column("place").to_numpy()
            order = np.lexsort((place, doc))
            doc, place = doc[order], place[order]
            raw, offs = utf8(t.column("bytes").combine_chunks().take(pa.array(order)))
            _, first, at = earliest_equal((raw, offs), length)
            row = np.repeat(np.arange(len(doc)), np.diff(offs))
            inside = np.arange(len(raw)) - offs[row]
            window = inside < (place[row] >> 16 & 127) + 1
            before = first[at] < at
            # equal windows at the same place of a repeated row are not earlier
            of = np.zeros(len(raw) + len(doc) + 2, np.int64)
            of[at] = np.arange(len(raw))
            f = of[first[at]]
            start = (place[row] >> 23) + inside
            before &= ~((doc[row] == doc[row[f]]) & (start == start[f])) if len(raw) else before
            hit = np.flatnonzero(before & window)
            new = np.ones(len(hit), bool)
            new[1:] = (np.diff(hit) != 1) | (row[hit][1:] != row[hit][:-1])
            heads = hit[new]
            n = np.diff(np.append(np.flatnonzero(new), len(hit)))
            return pa.RecordBatch.from_arrays(
                [pa.array(doc[row[heads]]), pa.array(_pack(start[heads], n, place[row[heads]] & 0xFFFF))], names=["doc", "place"])

        for b in batches:
            t = pa.Table.from_batches([b])
            a = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(a[1:] != a[:-1]) + 1).tolist(), len(a)]
            sizes = np.diff(utf8(b.column(3))[1])
            for i, j in zip(cuts[:-1], cuts[1:]):
                if i == j:
                    continue
                # a shard ends where an anchor does
                if size > SHARD_BYTES and (held_anchor != a[i]):
                    yield done(pa.concat_tables(held).combine_chunks())
                    held, size = [], 0
                if held and held[-1].num_rows == 0:
                    held.pop()
                held.append(t.slice(i, j - i))
                size += int(sizes[i:j].sum())
                held_anchor = a[j - 1]
        if held:
            yield done(pa.concat_tables(held).combine_chunks())

    return map_arrow(contexts, sort, "doc bigint, place bigint")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                   with_text: bool = False) -> DataFrame:
    """For each row: key, n_bytes, n_removed, n_spans, kept_sha256 of the bytes that stay, and
    spans (array of start, end); ``with_text`` adds those bytes as ``kept``."""
    prepare(docs.sparkSession)
    if not 8 <= length <= 128:
        raise ValueError("length must be 8 to 128")
    named = _renamed(docs, key, text)
    if named is None:
        return _remove(docs, key, text, length, with_text)
    rows, names = named
    out = _remove(rows, "doc", "text", length, with_text)
    return out.join(names, "doc").select(F.col("name").alias(key), *[c for c in out.columns if c != "doc"])


def _renamed(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame] | None:
    """Where a key is null, ``LAST``, or stands for several texts: rows (doc, text) and names (doc, name), doc being
    the place of (key, text's digest) in their order, a null key after all others. None where keys are names already."""
    rows = docs.select(F.col(key).cast("long").alias("name"), F.col(text).alias("text"))
    digest = F.xxhash64(F.coalesce("text", F.lit(""))), F.coalesce(F.octet_length("text"), F.lit(0))
    each = rows.select("name", digest[0].alias("h"), digest[1].alias("size"))
    unclear = each.groupBy("name").agg(F.min("h") != F.max("h"), F.min("size") != F.max("size")).toDF("name", "h", "size") \
        .where(F.col("name").isNull() | (F.col("name") == LAST) | F.col("h") | F.col("size"))
    if unclear.isEmpty():
        return None
    names = written(numbered(written(each.distinct(), "names"), [F.asc_nulls_last("name"), "size", "h"], "doc"), "numbered")
    same = F.col("a.name").eqNullSafe(F.col("b.name")) & (F.col("a.h") == F.col("b.h")) & (F.col("a.size") == F.col("b.size"))
    hashed = rows.withColumn("h", digest[0]).withColumn("size", digest[1])
    return hashed.alias("a").join(names.alias("b"), same).select("b.doc", "a.text"), names.select("doc", "name")


def _remove(docs: DataFrame, key: str, text: str, length: int, with_text: bool) -> DataFrame:
    runs = find_runs(docs, key, text, length) \
        .withColumn("digest", F.col("place").bitwiseAND(F.lit(0xFFFF)).cast("int")) \
        .groupBy("doc", "digest").agg(F.collect_list(F.shiftright("place", 16)).alias("runs"))
    keyed = _keyed(docs, key, text)
    rows = keyed.join(runs, ["doc", "digest"], "left").select("doc", "text", "runs")
    names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", *(["kept"] if with_text else [])]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches):
        for b in batches:
            raw, offs = utf8(b.column(1))
            runs = b.column(2)
            some = np.asarray(runs.is_valid().to_numpy(zero_copy_only=False), bool)
            removed, n_spans, digest, spans, kept = [], [], [], [], []
            for r in range(b.num_rows):
                body = raw[offs[r]:offs[r + 1]]
                if not some[r]:
                    removed.append(0)
                    n_spans.append(0)
                    spans.append([])
                    rest = body.tobytes()
                else:
                    p = runs[r].values.to_numpy()
                    s = p >> 7
                    e = s + (p & 127) + length
                    order = np.argsort(s, kind="stable")
                    s, e = s[order], np.maximum.accumulate(e[order])
                    head = np.append(True, s[1:] > e[:-1])
                    at = np.flatnonzero(head)
                    s, e = s[at], e[np.append(at[1:], len(e)) - 1]
                    mark = np.zeros(len(body) + 1, np.int64)
                    np.add.at(mark, s, 1)
                    np.add.at(mark, e, -1)
                    rest = body[np.cumsum(mark[:-1]) == 0].tobytes()
                    removed.append(int((e - s).sum()))
                    n_spans.append(len(s))
                    spans.append([{"start": int(x), "end": int(y)} for x, y in zip(s, e)])
                digest.append(hashlib.sha256(rest).hexdigest())
                if with_text:
                    kept.append(rest)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(offs)), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()),
                 pa.array(digest, pa.string()), pa.array(spans, kind), *([pa.array(kept, pa.binary())] if with_text else [])],
                names=names)

    schema = "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, " \
             "spans array<struct<start:bigint,end:bigint>>" + (", kept binary" if with_text else "")
    out = map_arrow(rows, cut, schema)
    return out.select(F.when(F.col("doc") != LAST, F.col("doc")).alias(key), *names[1:])
