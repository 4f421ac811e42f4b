"""Token-ID output in training order.

Texts are tokenized with a public byte-level BPE vocabulary (a path; nothing is
trained), an end-of-text ID follows each document, and documents are cut into
sequences of ``seq_len`` IDs (the last one is padded with the end-of-text ID, its
``n_tokens`` counts the others and the closing one). Every sequence gets a global
slot, the image of its number under a keyed Feistel permutation with cycle-walking,
so slots 0..N-1 are a random training order without sorting by a random key. Slots
are cut into shards of ``shard_rows`` consecutive slots; one range partition writes
a shard's sequences in slot order with a fixed stride (2 bytes an ID, little endian),
so sequence i of a shard is at byte i * stride and a reader resumes at any slot.

The sequences are numbered by (block, position in the block), a block being what one
task tokenizes; tokens are written once to the shared folder, only counts of blocks
reach the driver. Reruns over the same input layout and key give the same slots.

Splitting into words follows the vocabulary's pattern, but in numpy over code points
of many texts at once; each distinct word is encoded once for a batch and kept in a
bounded memo, which is several times faster than encoding text by text and gives the
same IDs (tests compare both).

Defined cases: a null or empty text is one sequence that holds only the end-of-text
ID; repeated rows are separate sequences; empty tables give empty results. Columns
besides key and text are not read.
"""

from __future__ import annotations

import base64
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmplake.llm.common import LONG_SPAN, U64, chunks, map_arrow, mix, powers, prepare, strong_hash, utf8, written
from lmplake.llm.feistel import permute
from lmplake.session import lake_root

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary's word pattern (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_TEXT = 50256
SEQ_LEN = 512
SHARD_ROWS = 16384
KEY = 6
#: Words that a worker keeps, and bytes of text whose distinct words are looked up at once.
MEMO = 1_500_000
BATCH_BYTES = 4 << 20
#: Sequences that one read of a shard file takes.
READ_ROWS = 1024
#: Runs in which ``materialised`` writes the shards.
WAVES = 4

_OTHER, _LETTER, _NUMBER, _SPACE, _END = range(5)


def load(path: str = VOCABULARY):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def classes() -> np.ndarray:
    """Class of each code point, and of the mark behind the last of a text (0x110000)."""
    import regex
    chars = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
    out = np.full(0x110001, _OTHER, np.uint8)
    out[0x110000] = _END
    for pattern, kind in ((r"\p{L}+", _LETTER), (r"\p{N}+", _NUMBER), (r"\s+", _SPACE)):
        for m in regex.finditer(pattern, chars):
            a, b = m.span()
            a, b = (x + 0x800 * (x >= 0xD800) for x in (a, b - 1))
            out[a:b + 1] = kind
    out[0xD800:0xE000] = _OTHER
    return out


def word_starts(cp: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Which code points start a word of the pattern; every text ends with a mark of its own."""
    kind = cls[cp]
    n = len(cp)
    prev = np.append(np.uint8(_END), kind[:-1])
    nxt = np.append(kind[1:], np.uint8(_END))
    start = kind != prev
    start |= kind == _END
    # the last blank of a run goes to what follows: a space joins it, others stand alone
    last = (kind == _SPACE) & (nxt != _SPACE) & (nxt != _END)
    start |= last
    joined = last & (cp == 32)
    start[1:] &= ~joined[:-1]
    # contractions: an apostrophe that starts a word, and the one or two letters behind it
    q = np.flatnonzero((cp == 39) & start & (nxt == _LETTER))
    if len(q):
        pad = np.append(cp, np.zeros(3, cp.dtype))
        a, b = pad[q + 1], pad[q + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        size = np.where(one, 1, np.where(two, 2, 0))
        q, size = q[size > 0], size[size > 0]
        start[q + 1] = False
        stop = q + 1 + size
        stop = stop[stop < n]
        start[stop[kind[stop] == _LETTER]] = True
    return start


class Tokenizer:
    """IDs of many texts at once; see the module's text.

    The memo is three flat arrays: sorted word hashes, and where each word's IDs
    stand in one array; it starts anew beyond ``MEMO`` words."""

    def __init__(self, path: str):
        self.enc, self.cls = load(path), classes()
        self.value = mix(np.arange(1, 0x110002, dtype=U64))
        self.forget()

    def forget(self) -> None:
        self.keys, self.base, self.count = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint16)

    def split(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The joined texts, their words' starts, ends and hashes, and each text's last word (its mark)."""
        joined = "\x00".join(texts) + "\x00"
        cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32).copy()
        marks = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        cp[marks] = 0x110000
        s = np.flatnonzero(word_starts(cp, self.cls))
        e = np.append(s[1:], len(cp))
        p, q = powers(len(cp) + 1)
        sums = np.zeros(len(cp) + 1, U64)
        np.cumsum(self.value[cp] * p[:-1], out=sums[1:])
        h = mix((sums[e] - sums[s]) * q[s] + (e - s).astype(U64))
        for i in np.flatnonzero(e - s > LONG_SPAN):
            h[i] = strong_hash(joined[s[i]:e[i]].encode())
        return joined, s, e, h, np.searchsorted(s, marks)

    def learn(self, keys: np.ndarray, words: list[str | None]) -> None:
        """Add words (None: the mark) to the memo."""
        if len(self.keys) + len(keys) > MEMO:
            self.forget()
        ids = [[END_OF_TEXT] if w is None else self.enc._encode_single_piece(w) for w in words]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        base = len(self.flat) + np.cumsum(n) - n
        self.flat = np.concatenate([self.flat, np.fromiter((x for y in ids for x in y), np.uint16, int(n.sum()))])
        keys, base, count = (np.concatenate(x) for x in ((self.keys, keys), (self.base, base), (self.count, n)))
        order = np.argsort(keys)
        self.keys, self.base, self.count = keys[order], base[order], count[order]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All IDs as uint16, and the texts' offsets (end-of-text IDs included)."""
        size = np.append(0, np.cumsum([len(t) for t in texts]))
        parts = [self.split(texts[i:j]) for i, j in chunks(size, 1 << 17)]
        uniques, first, inverse = np.unique(np.concatenate([p[3] for p in parts]), return_index=True, return_inverse=True)
        if len(self.keys) + len(uniques) > MEMO:
            self.forget()
        at = np.searchsorted(self.keys, uniques)
        at[at == len(self.keys)] = 0
        new = np.flatnonzero(self.keys[at] != uniques) if len(self.keys) else np.arange(len(uniques))
        if len(new):
            place = first[new]
            ends = np.cumsum([len(p[1]) for p in parts])
            which = np.searchsorted(ends, place, side="right")
            mark = np.zeros(ends[-1], bool)
            mark[np.concatenate([p[4] + d - len(p[1]) for p, d in zip(parts, ends)])] = True
            start, end = (np.concatenate([p[k] for p in parts])[place].tolist() for k in (1, 2))
            self.learn(uniques[new], [None if m else parts[w][0][i:j] for m, w, i, j in
                                      zip(mark[place].tolist(), which.tolist(), start, end)])
        at = np.searchsorted(self.keys, uniques)
        base, n = self.base[at], self.count[at]
        ids, offsets, done, word = [], [np.zeros(1, np.int64)], 0, 0
        for _, s, _, _, marks in parts:
            own = inverse[word:word + len(s)]
            word += len(s)
            count = n[own]
            ends = np.cumsum(count)
            ids.append(self.flat[np.repeat(base[own] - (ends - count), count) + np.arange(int(ends[-1]))])
            offsets.append(done + ends[marks])
            done += int(ends[-1])
        return np.concatenate(ids), np.concatenate(offsets)


_TOKENIZERS: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """One tokenizer for each worker process, which serves its later tasks too."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Tokenizer(path)
    return _TOKENIZERS[path]


def sequences(docs: DataFrame, key: str, text: str, seq_len: int, vocabulary: str) -> DataFrame:
    """(block, nth, key, part, n_tokens, ids): the padded sequences of each document."""
    src = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = src.schema["_key"].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext
        tok, nth, block = tokenizer(vocabulary), 0, TaskContext.get().partitionId()
        for b in batches:
            if not b.num_rows:
                continue
            offs = utf8(b.column(1))[1]
            for i, j in chunks(offs, BATCH_BYTES):
                ids, at = tok.encode([t or "" for t in b.column(1).slice(i, j - i).to_pylist()])
                size = np.diff(at)
                count = -(-size // seq_len)
                row = np.repeat(np.arange(j - i), count)
                part = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                n = np.minimum(seq_len, size[row] - part * seq_len)
                out = np.full((len(row), seq_len), END_OF_TEXT, "<u2")
                inside = np.arange(seq_len) < n[:, None]
                out[inside] = ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), block, np.int32)), pa.array(nth + np.arange(len(row))),
                     b.column(0).slice(i, j - i).take(pa.array(row)), pa.array(part.astype(np.int32)),
                     pa.array(n.astype(np.int32)),
                     pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * seq_len), len(row), [None, pa.py_buffer(out)]).cast(pa.binary())],
                    names=["block", "nth", "key", "part", "n_tokens", "ids"])
                nth += len(row)

    return map_arrow(src, run, f"block int, nth bigint, key {kind}, part int, n_tokens int, ids binary")


def _placed(docs: DataFrame, key: str, text: str, seq_len: int, shard_rows: int, seed: int, vocabulary: str) -> tuple[DataFrame, int]:
    """The columns of ``training_order``, in no order, and the number of shards."""
    seqs = written(sequences(docs, key, text, seq_len, vocabulary), "sequences")
    counts = sorted((r["block"], r["n"]) for r in seqs.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect())
    total = sum(n for _, n in counts)
    base, at = {}, 0
    for block, n in counts:
        base[block], at = at, at + n

    @F.pandas_udf("long")
    def slot(block, nth):
        import pandas as pd
        number = block.map(base).to_numpy(np.int64) + nth.to_numpy(np.int64)
        return pd.Series(permute(number, total, seed))

    placed = seqs.withColumn("slot", slot("block", "nth")) \
        .withColumn("shard", F.floor(F.col("slot") / F.lit(shard_rows)).cast("int")) \
        .select("slot", "shard", (F.col("slot") % shard_rows).cast("int").alias("row"), F.col("key").alias(key), "part",
                "n_tokens", "ids")
    return placed, max(1, -(-total // shard_rows))


def _in_order(placed: DataFrame, n_shards: int) -> DataFrame:
    return placed.repartitionByRange(n_shards, "shard").sortWithinPartitions("slot")


def training_order(docs: DataFrame, key: str = "doc_id", text: str = "text", seq_len: int = SEQ_LEN,
                   shard_rows: int = SHARD_ROWS, seed: int = KEY, vocabulary: str = VOCABULARY) -> DataFrame:
    """(slot, shard, row, key, part, n_tokens, ids), range-partitioned by shard and
    sorted by slot: partitions hold whole shards, row is the place in the shard."""
    return _in_order(*_placed(docs, key, text, seq_len, shard_rows, seed, vocabulary))


INDEX_SCHEMA = "slot bigint, shard int, row int, key {kind}, part int, n_tokens int, path string"


def index_shards(ordered: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """Write ``ordered`` (of ``training_order``) as ``shard-<n>.bin`` files below ``folder``
    (a path that pyarrow opens from every executor) and return where each sequence is: (slot,
    shard, row, key, part, n_tokens, path). A file is written under a name of its own and moved into
    place when complete, so a repeated task replaces it whole; its rows are given out after that."""
    kind = ordered.schema[key].dataType.simpleString()

    def run(batches):
        import uuid

        from lmplake.sources.paths import fs_for
        store, root = fs_for(folder)
        now, out, temp, rows = None, None, None, []

        def close():
            out.close()
            path = f"{root}/shard-{now:06d}.bin"
            store.move(temp, path)
            for r in rows:
                yield r.append_column("path", pa.array([path] * len(r)))

        store.create_dir(root, recursive=True)
        for b in batches:
            raw, offs = utf8(b.column(6))
            shard = b.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(shard)) + 1
            for i, j in zip([0, *cuts], [*cuts, len(shard)]):
                if i == j:
                    continue
                if now != int(shard[i]):
                    if out is not None:
                        yield from close()
                    now, rows = int(shard[i]), []
                    temp = f"{root}/_{uuid.uuid4().hex}"
                    out = store.open_output_stream(temp)
                out.write(raw[offs[i]:offs[j]])
                # a copy, so that the batch with its IDs can go
                rows.append(pa.RecordBatch.from_arrays([c.take(pa.array(np.arange(i, j))) for c in b.columns[:6]],
                                                       names=["slot", "shard", "row", "key", "part", "n_tokens"]))
        if out is not None:
            yield from close()

    src = ordered.select("slot", "shard", "row", F.col(key).alias("key"), "part", "n_tokens", "ids")
    return map_arrow(src, run, INDEX_SCHEMA.format(kind=kind))


def write_shards(ordered: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """Write the files of ``index_shards``; their manifest (shard, first_slot, rows, path)."""
    return index_shards(ordered, folder, key).groupBy("shard", "path") \
        .agg(F.min("slot").alias("first_slot"), F.count(F.lit(1)).alias("rows")).select("shard", "first_slot", "rows", "path")


def read_shards(index: DataFrame, folder: str, key: str = "doc_id", seq_len: int = SEQ_LEN) -> DataFrame:
    """The columns of ``training_order`` for the rows of ``index`` (a table of ``index_shards``), with the IDs
    from the files below ``folder``: rows that follow one another in a file are one sequential read."""
    kind = index.schema["key"].dataType.simpleString()
    stride = 2 * seq_len

    def run(batches):
        from lmplake.sources.paths import fs_for
        store, _ = fs_for(folder)
        for b in batches:
            path, row = b.column(6).to_pylist(), b.column(2).to_numpy().astype(np.int64)
            runs = [0, *(i for i in range(1, len(row)) if path[i] != path[i - 1] or row[i] != row[i - 1] + 1), len(row)]
            for s, e in zip(runs[:-1], runs[1:]):
                for i in range(s, e, READ_ROWS):
                    j = min(e, i + READ_ROWS)
                    with store.open_input_file(path[i]) as f:
                        f.seek(int(row[i]) * stride)
                        data = f.read_buffer((j - i) * stride)
                    if data.size != (j - i) * stride:
                        raise ValueError(f"{path[i]} ends before row {int(row[j - 1])}")
                    ids = pa.FixedSizeBinaryArray.from_buffers(pa.binary(stride), j - i, [None, data]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in b.columns[:6]), ids],
                                                     names=["slot", "shard", "row", "key", "part", "n_tokens", "ids"])

    out = map_arrow(index, run, f"slot bigint, shard int, row int, key {kind}, part int, n_tokens int, ids binary")
    return out.withColumnRenamed("key", key)


@contextmanager
def shuffles_removed(spark):
    """Shuffle files go when the job that made them has ended, not when the driver next collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialised(docs: DataFrame, key: str = "doc_id", text: str = "text", seq_len: int = SEQ_LEN,
                 shard_rows: int = SHARD_ROWS, seed: int = KEY, vocabulary: str = VOCABULARY) -> DataFrame:
    """``training_order`` written as shard files in the shared folder, and read back from them.

    The shards are written in ``WAVES`` runs of neighbouring ones, each a shuffle of its own over the table of
    sequences, so that beside that table and the files only a part of the sequences is on disk a third time."""
    spark = docs.sparkSession
    prepare(spark)
    placed, n_shards = _placed(docs, key, text, seq_len, shard_rows, seed, vocabulary)
    folder = f"{lake_root(spark)}-shards"
    step, index = -(-n_shards // WAVES), None
    with shuffles_removed(spark):
        for first in range(0, n_shards, step):
            wave = _in_order(placed.where(F.col("shard").between(first, first + step - 1)), step)
            part = written(index_shards(wave, folder, key), f"index-{first}")
            index = part if index is None else index.unionByName(part)
    return read_shards(index, folder, key, seq_len)


def read_sequence(path: str, row: int, seq_len: int = SEQ_LEN) -> np.ndarray:
    """The IDs of one row of a shard file, read at its fixed offset."""
    from pyarrow import fs
    store, p = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    with store.open_input_file(p) as f:
        f.seek(row * 2 * seq_len)
        return np.frombuffer(f.read(2 * seq_len), "<u2")
