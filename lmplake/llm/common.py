"""Helpers shared by the training-data operators.

* intermediate tables go to the shared folder named by ``spark.checkpoint.dir``
  (``written``), so a lost executor only re-reads them;
* text batches are handled as one byte array plus offsets, so the numpy kernels
  touch each byte a fixed number of times and never loop over rows;
* ``with_rank`` numbers the rows of a group without putting the group in one task.
"""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lmplake.session import ensure_checkpoint_dir, lake_root, ship_package

# Bytes of text that a numpy kernel handles at once (memory per task stays a
# fixed multiple of this, or of the longest single text).
CHUNK_BYTES = 2 << 20
U64 = np.uint64
_B = U64(0x9E3779B97F4A7C15 | 1)
_B_INV = U64(pow(int(_B), -1, 1 << 64))


def prepare(spark: SparkSession) -> None:
    """Shared checkpoint folder set, and this package importable in Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


_scopes: list[list[str]] = []  # tables written by the calls of ``settled`` that are under way


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back (cuts the
    lineage; survives lost executors)."""
    spark = df.sparkSession
    path = f"{lake_root(spark)}-{name}"
    df.write.option("compression", "zstd").parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """``build()`` written as a table; the tables that were written on the way to it are removed
    once it stands, so that an operator's disk is that of its own steps and not of all before."""
    _scopes.append([])
    try:
        result = build()
        on_the_way = list(_scopes[-1])
        out = written(result, name)
        kept = _scopes[-1][len(on_the_way):]
    finally:
        _scopes.pop()
    if _scopes:
        _scopes[-1].extend(kept)
    for path in on_the_way:
        remove(spark, path)
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder, through Spark's own file systems."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores before it until no column (in any case) is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def release() -> None:
    """Give freed memory back to the machine: a Python worker lives on for later tasks
    and stages, and keeps what its allocators hold otherwise."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    prepare(df.sparkSession)

    def task(batches):
        try:
            yield from fn(batches)
        finally:
            release()

    return df.mapInArrow(task, schema)


# ---------------------------------------------------------------- text batches

def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string (or binary) column and its n+1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    big = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    o = np.frombuffer(offs, np.int64 if big else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) \
        if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return raw, o - o[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) whose texts hold about ``limit`` bytes (at least one row)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), vectorised."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, n of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        m = max(n, CHUNK_BYTES + 64)
        p = np.full(m, _B, U64)
        q = np.full(m, _B_INV, U64)
        p[0] = q[0] = 1
        _POWERS[:] = [np.multiply.accumulate(p), np.multiply.accumulate(q)]
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """H with H[e]-H[s] the (shifted) polynomial hash of raw[s:e]; see ``span_hash``."""
    p, _ = powers(len(raw) + 1)
    out = np.zeros(len(raw) + 1, U64)
    np.cumsum(_BYTE_VALUES[raw] * p[:len(raw)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [s, e), equal for equal spans."""
    _, q = powers(len(prefix))
    return mix((prefix[e] - prefix[s]) * q[s] + (e - s).astype(U64))


#: A polynomial modulo a power of two has families of long strings that collide whatever its base (of some
#: 1,000 letters for 64 bits); spans beyond this length are hashed by ``strong_hash``.
LONG_SPAN = 128


def strong_hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


def word_hash(raw: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words [s, e) of a byte array."""
    h = span_hash(prefix_hash(raw), s, e)
    for i in np.flatnonzero(e - s > LONG_SPAN):
        h[i] = strong_hash(raw[s[i]:e[i]].tobytes())
    return h


# The six bytes that separate words (the complement of the contract's word pattern).
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words; a word never crosses a row."""
    solid = ~_IS_SPACE[raw]
    starts = solid.copy()
    starts[1:] &= ~solid[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[first] = solid[first]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    last = first_to_last(offsets)
    ends[last] = solid[last]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(offsets, s, side="right") - 1


def first_to_last(offsets: np.ndarray) -> np.ndarray:
    return (offsets[1:] - 1)[offsets[:-1] < offsets[1:]]


# ---------------------------------------------------------------- joins

HEAVY_KEYS = 10_000


def join_sized(left: DataFrame, right: DataFrame, keys: list[str], count: str, total: int, how: str = "left") -> DataFrame:
    """``left.join(right, keys, how)`` for a ``right`` with one row for each key and the
    number ``count`` of the key's rows on the left, of ``total``.

    Keys with more than total / HEAVY_KEYS rows - there can't be more than HEAVY_KEYS of
    them - are broadcast, so their rows stay where they are; the other keys have few rows
    each and are joined by a shuffle. A key with a third of all rows meets in no task."""
    bound = max(1, -(-int(total) // HEAVY_KEYS))
    heavy, light = right.where(F.col(count) > bound), right.where(F.col(count) <= bound)
    hot = left.join(F.broadcast(heavy), keys, "inner")
    rest = left.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(light, keys, how)
    return hot.unionByName(rest)


# ---------------------------------------------------------------- positions

def with_rank(df: DataFrame, key: str, out: str, order: list[str], u: str, rows_per_bin: int = 4096,
              key_counts: dict | None = None, together: tuple[str, str, str] | None = None) -> DataFrame:
    """Append ``out``: 0-based gapless position of each row among the rows with
    the same (non-null) ``key``, ordered by the 32-bit hash column ``u``, then
    ``order``.

    A key is cut into bins of the hash (about ``rows_per_bin`` rows each, bins
    grow in number with the table), so even a key with a third of all rows is
    numbered by many tasks: bin counts are summed over bins, rows are numbered
    inside their bin. Rows equal in ``u`` and ``order`` take any order.

    ``together`` names a non-null string column whose equal rows have one ``u`` and shall stand in a line, the column with
    their number and a 32-bit hash of the row: a value with more rows than a bin has bins of its own, cut by that hash."""
    total = sum(key_counts.values()) if key_counts is not None else df.count()
    bins = max(1, -(-total // rows_per_bin))
    b = F.floor(F.col(u).cast("double") * F.lit(bins) / F.lit(float(1 << 32))).cast("long")
    own, sub = F.lit(""), F.lit(0).cast("long")
    if together:
        value, rows, h = (F.col(c) for c in together)
        large = F.coalesce(rows > rows_per_bin, F.lit(False))
        own = F.when(large, F.concat(F.lit("="), value)).otherwise(own)
        sub = F.when(large, F.floor(h.cast("double") * F.ceil(rows / rows_per_bin) / F.lit(float(1 << 32))).cast("long")).otherwise(sub)
    cut = ["_bin", "_own", "_sub"]
    tagged = df.withColumn("_bin", b).withColumn("_own", own).withColumn("_sub", sub)
    counts = tagged.groupBy(key, *cut).agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy(key).orderBy(*cut).rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in cut],
                         F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(key, *cut).orderBy(u, *order)
    ranked = tagged.withColumn("_r", F.row_number().over(inside) - 1)
    return (ranked.join(base, [F.col(key) == F.col("_k"), *[F.col(c) == F.col(f"_{c}") for c in cut]])
            .withColumn(out, (F.col("_base") + F.col("_r")).cast("long"))
            .drop("_r", "_k", "_base", *cut, *[f"_{c}" for c in cut]))


RANGE_ROWS, MOST_RANGES = 1 << 13, 20_000


def sorted_ranges(df: DataFrame, order: list, out: str) -> DataFrame:
    """``df``, a written table, cut into sorted ranges of about ``RANGE_ROWS`` rows, a task each; ``out`` is the
    range's number times 2^33 plus the row's number in it."""
    n = max(1, min(MOST_RANGES, -(-df.count() // RANGE_ROWS)))
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(out, F.monotonically_increasing_id())


def numbered(df: DataFrame, order: list, out: str) -> DataFrame:
    """Append ``out``, gapless from 0 in the order of ``order`` (``df`` is a written table;
    at most ``MOST_RANGES`` sums are broadcast)."""
    cut = written(sorted_ranges(df, order, "_at"), "ranges").withColumn("_range", F.shiftright("_at", 33))
    n = cut.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    base = n.select("_range", F.coalesce(F.sum("_n").over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return cut.join(F.broadcast(base), "_range").withColumn(out, (F.col("_base") + inside).cast("long")) \
        .drop("_at", "_range", "_base")


def u32(*cols) -> F.Column:
    """A uniform 32-bit hash of the columns, as a non-negative long."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 32)
