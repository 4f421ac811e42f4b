"""Sets of node ids as bitmaps (S9, J2): 4 KB for each 32,768 numbers, whatever the number of rows they come from.

A set is a few rows (day, bucket, bits), by Spark's own bitmap functions; unions are ``bitmap_or_agg``, differences are
taken on the 64-bit words of two bitmaps, and members are listed only where a word isn't zero. Node ids that lie
close together share buckets; scattered ones take a bucket each, mostly zeros, which Parquet's compression removes.
NULL is a member like another (bucket NULL). Ids of -2^63 are not supported, as in Spark's functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = 32768
WORDS = BUCKET // 64


def node_sets(rows: DataFrame, day_col: str = "pricedate", node_col: str = "node_id") -> DataFrame:
    """(day, bucket, bits) of the nodes of each day. Rows are made distinct before they become bits, by a hash
    aggregate with map-side combine, so a node with many rows costs no more than one with a few."""
    nodes = rows.select(day_col, F.col(node_col).cast("bigint").alias("_node")).distinct()
    return nodes.groupBy(day_col, F.bitmap_bucket_number("_node").alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.coalesce(F.bitmap_bit_position("_node"), F.lit(0))).alias("bits"))


def words(bits: Column | str) -> Column:
    """The bitmap as 64-bit numbers; the first byte of eight is the highest of its word."""
    b = F.col(bits) if isinstance(bits, str) else bits
    return F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)),
                       lambda i: F.conv(F.hex(F.substr(b, i * 8 + 1, F.lit(8))), 16, -10).cast("bigint"))


def minus(a: Column | str, b: Column | str) -> Column:
    """Words of the members of ``a`` that are not in ``b``."""
    return F.zip_with(words(a), words(b), lambda x, y: x.bitwiseAND(F.bitwise_not(y)))


def members(sets: DataFrame, member_words: Column, day_col: str = "pricedate") -> DataFrame:
    """(day, node_id): the members that ``member_words`` (of a row of ``sets``) has, one row each."""
    numbered = F.transform(member_words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    some = sets.select(day_col, "bucket", F.explode(F.filter(numbered, lambda x: x.w != 0)).alias("_x"))
    bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda j: F.getbit(F.col("_x.w"), j) == 1)
    each = some.select(day_col, "bucket", F.col("_x.i").alias("_i"), F.explode(bits).alias("_j"))
    at = (F.col("_i") * 64 + (F.lit(7) - F.floor(F.col("_j") / 8)) * 8 + F.col("_j") % 8).cast("bigint")
    node = F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * BUCKET + at + 1).otherwise(F.col("bucket") * BUCKET - at)
    return each.select(day_col, node.alias("node_id"))


def holds_any(nodes: list[int], bits: str = "bits") -> Column:
    """Whether a row (bucket, bits) has one of the nodes. The buckets are a literal filter, which reaches the Parquet scan."""
    def one(n: int) -> Column:
        byte = F.conv(F.hex(F.substr(F.col(bits), F.lit(_position(n) // 8 + 1), F.lit(1))), 16, 10).cast("int")
        return (F.col("bucket") == _bucket(n)) & (byte.bitwiseAND(F.lit(1 << _position(n) % 8)) != 0)

    any_of = F.lit(False)
    for n in nodes:
        any_of = any_of | one(n)
    return F.col("bucket").isin(sorted({_bucket(n) for n in nodes})) & any_of


def _bucket(n: int) -> int:
    return 1 + (n - 1) // BUCKET if n > 0 else -(-n // BUCKET)


def _position(n: int) -> int:
    return (n - 1) % BUCKET if n > 0 else -n % BUCKET
