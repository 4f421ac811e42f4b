"""JSON page scans (S1, U1) and page building for the file-backed transport.

A page is a JSON array of flat records. Read with an explicit schema (no
inference, so pages never disagree on types) and FAILFAST, the way the
reference aborts a pull on any undecodable page. One multi-file scan
replaces the per-page decode + concat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lmplake.feeds import FeedSpec
from lmplake.operators.positions import positions_within


# No JSON text holds a NUL (in a string it is escaped), so with this as line separator a page file is one line.
WHOLE_FILE = "\0" * 8


def read_json_pages(spark: SparkSession, paths: str | list[str], spec: FeedSpec,
                    with_provenance: bool = True) -> DataFrame:
    """All records of all page files under ``paths``, line breaks inside a page or not.

    Each file is read at once and parsed from memory. With ``multiLine`` Spark parses the open file, and to keep the
    literal text of a number that is read as text it goes back to the file for every one of them."""
    r = (spark.read.schema(spec.raw_schema())
         .option("lineSep", WHOLE_FILE).option("mode", "FAILFAST")
         .json(paths))
    if with_provenance:
        r = r.select("*", F.col("_metadata.file_path").alias("file_path"))
    return r


def parse_page_text(pages: DataFrame, spec: FeedSpec, text_col: str = "page_text",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Page texts already in a column (e.g. a message or HTTP body table)."""
    arr = F.from_json(F.col(text_col), T.ArrayType(spec.raw_schema()), {"mode": "FAILFAST"})
    return pages.select(*keep, F.explode(arr).alias("_r")).select(*keep, "_r.*")


def build_pages(raw: DataFrame, spec: FeedSpec, pull_cols: list[str], order_col: str,
                page_size: int) -> DataFrame:
    """Cut raw records into API-shaped pages: ``(pull, page_index, start_row,
    n_rows, page_text)``. Row positions come from ``positions_within`` (no
    whole-pull sort in one task); a page holds at most ``page_size`` rows, so
    collecting one page is bounded."""
    pos = positions_within(raw, pull_cols, order_col)
    page = F.floor((F.col("position") - 1) / F.lit(page_size)).cast("bigint")
    rec = F.struct(F.col("position").alias("p"), F.struct(*[F.col(f) for f in spec.api_fields]).alias("r"))
    # collect_list has no order; sort each page by position so records keep
    # the pull's order (the row number within the pull is derived from it)
    ordered = F.transform(F.array_sort(F.collect_list(rec)), lambda x: x["r"])
    return (
        pos.withColumn("page_index", page)
        .groupBy(*pull_cols, "page_index")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.to_json(ordered).alias("page_text"))
        .withColumn("start_row", F.col("page_index") * F.lit(page_size) + F.lit(1))
    )
