"""Intake and day-table scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from lmplake.feeds import FeedSpec
from lmplake.operators.merge import SEQ_COL
from lmplake.sources.paths import day_folders


def lake_schema(spec: FeedSpec):
    s = spec.price_schema()
    return T.StructType([*s.fields, T.StructField(SEQ_COL, T.LongType(), True)])


#: Folder columns are typed by their names, not by files.
FOLDER_COLUMNS = ("pricedate", "landing")


def wide_schema(schema: T.StructType) -> T.StructType:
    """A schema that files of any writer are read with, whatever width and sign their integers and floats
    have: integers as 20-digit decimals, which hold int16 to int64 and uint64, floats as doubles. The scan widens
    each file by itself, so a folder (or a micro-batch) may mix them, and no footer is looked at before."""
    wide = lambda f: T.DecimalType(20, 0) if isinstance(f.dataType, T.IntegralType) and f.name not in FOLDER_COLUMNS else f.dataType
    return T.StructType([T.StructField(f.name, wide(f), True) for f in schema.fields])


def narrow_columns(schema: T.StructType) -> list[Column]:
    """The columns of ``schema`` from a scan with its wide schema; a value that doesn't fit fails the job."""
    return [F.col(f.name).cast(f.dataType).alias(f.name) if isinstance(f.dataType, T.IntegralType) and f.name not in FOLDER_COLUMNS
            else F.col(f.name) for f in schema.fields]


def _read_any(spark: SparkSession, paths: list[str], schema: T.StructType, base: str) -> DataFrame:
    return spark.read.schema(wide_schema(schema)).option("basePath", base).parquet(*paths)


def intake_schema(spec: FeedSpec):
    """Landed rows with their landing (a folder below the day)."""
    return T.StructType([*lake_schema(spec).fields, T.StructField("landing", T.LongType())])


def _read_days(spark: SparkSession, root: str, schema, days):
    """The table under ``root``; with ``days``, only those day folders are
    listed and read (a path-based read would list every day of the table
    first). Days without a folder are skipped; ``None`` when none exists."""
    if days is None:
        return spark.read.schema(schema).parquet(root)
    folders = day_folders(root, days)
    if not folders:
        return None
    return spark.read.schema(schema).option("basePath", root).parquet(*folders)


def scan_intake(spark: SparkSession, intake_dir: str, spec: FeedSpec, days=None) -> DataFrame:
    """Landed rows with provenance. With ``days`` (dates) only those day
    folders are listed and read."""
    folders = [intake_dir] if days is None else day_folders(intake_dir, days)
    if not folders:
        r = spark.createDataFrame([], lake_schema(spec))
        return r.select("*", F.lit(None).cast("string").alias("file_path"),
                        F.lit(None).cast("timestamp").alias("file_modification_time"))
    r = _read_any(spark, folders, lake_schema(spec), intake_dir)
    return r.select(*narrow_columns(lake_schema(spec)), F.col("_metadata.file_path").alias("file_path"),
                    F.col("_metadata.file_modification_time").alias("file_modification_time"))


def intake_files(spark: SparkSession, intake_dir: str, days=None) -> DataFrame:
    """(file_path) of the landed files, of ``days`` when given: a listing, no row is read."""
    folders = [intake_dir] if days is None else day_folders(intake_dir, days)
    if not folders:
        return spark.createDataFrame([], "file_path string")
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
            .load(folders).select(F.col("_metadata.file_path").alias("file_path")))


def read_intake_files(spark: SparkSession, intake_dir: str, paths: list[str], spec: FeedSpec) -> DataFrame:
    """The rows of exactly these landed files, with provenance."""
    if not paths:
        return spark.createDataFrame([], lake_schema(spec)).withColumn("file_path", F.lit(None).cast("string"))
    from urllib.parse import unquote
    r = _read_any(spark, [unquote(p) for p in paths], lake_schema(spec), intake_dir)
    return r.select(*narrow_columns(lake_schema(spec)), F.col("_metadata.file_path").alias("file_path"))


def scan_day_table(spark: SparkSession, table_dir: str, spec: FeedSpec, days=None) -> DataFrame:
    """Existing day rows, or an empty frame of the lake schema when the table
    does not exist yet. Any other read error propagates: a day that cannot be
    read must never be treated as empty (it would be overwritten)."""
    try:
        r = _read_days(spark, table_dir, lake_schema(spec), days)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], lake_schema(spec))
        raise
    # with the schema given, a folder that holds only ``_staging`` reads as empty
    return r if r is not None else spark.createDataFrame([], lake_schema(spec))


def list_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """File listing without reading contents: path, length, modification time."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(root)
            .select("path", "length", "modificationTime"))
