"""A day table whose readers never see a publish half done (K3).

The rows of a day are in a folder of the version that wrote them, ``<table>/versions/v=<n>/pricedate=<day>``, and
``<table>/_manifest/<n>`` says which version each day is read from. A merge writes the days it touches as a new version
and then a manifest that names it; the manifest appears by one rename, and that rename is the publish: before it readers
see the old days, after it all of the new ones. Nothing that a reader holds is overwritten; a reader resolves the manifest
once and reads that state however many versions follow.

The rename doesn't replace: of two writers that start from one version one commits, the other finds its number
taken and merges again on top of the new state. So the table takes several writers at a time.

With each version stand the node sets of its days, as bitmaps (``<table>/nodes/v=<n>/pricedate=<day>``): ``bits`` has all nodes
of the day, ``fresh`` those that this version's merge brought rows for. The manifest publishes both together. A set is the union of the
set before and the one of the new rows, so inventory, carried-over nodes and the days that hold a node come without a look at price rows.

A manifest has one entry a day, so it is bounded by the calendar. ``vacuum`` removes what no manifest of the last ``keep``
refers to: older manifests, their days, and versions that never got a manifest.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lmplake.feeds import KEY_COLUMNS, FeedSpec
from lmplake.operators.merge import SEQ_COL, merge_rows
from lmplake.operators.node_sets import holds_any, members, minus, node_sets, words
from lmplake.session import reliable_checkpoint
from lmplake.sinks.lake import NODE_BLOOM, lake_columns
from lmplake.sinks.landings import Files
from lmplake.sources.intake import lake_schema

NODE_SETS = "pricedate date, bucket long, bits binary, fresh binary"
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"
TRIES = 20


def _day_name(day) -> str:
    return NULL_DAY if day is None else day.isoformat()


def latest_version(spark: SparkSession, table_dir: str) -> int:
    """Number of the newest manifest; 0 for a table without one."""
    return max((int(n) for n in Files(spark, table_dir).names("_manifest") if n.isdigit()), default=0)


def read_manifest(spark: SparkSession, table_dir: str, version: int) -> dict[str, str]:
    """Folder (below ``versions``) of each day at a version."""
    if version == 0:
        return {}
    text = Files(spark, table_dir).read(f"_manifest/{version}")
    if text is None:
        raise FileNotFoundError(f"version {version} of {table_dir} does not exist (any more)")
    return json.loads(text)


def _read_days(spark, table_dir, sub, schema, days, version) -> DataFrame:
    at = latest_version(spark, table_dir) if version is None else version
    manifest = read_manifest(spark, table_dir, at)
    wanted = manifest if days is None else {n: manifest[n] for n in map(_day_name, days) if n in manifest}
    if not wanted:
        return spark.createDataFrame([], schema)
    base = f"{table_dir.rstrip('/')}/{sub}"
    return spark.read.schema(schema).option("basePath", base) \
        .parquet(*[f"{base}/{folder}/pricedate={day}" for day, folder in sorted(wanted.items())])


def read_versioned(spark: SparkSession, table_dir: str, spec: FeedSpec, days=None, version: int | None = None) -> DataFrame:
    """The table as of ``version`` (default: the newest one), or only ``days`` of it."""
    return _read_days(spark, table_dir, "versions", lake_schema(spec), days, version).select(*lake_columns(spec))


def read_node_sets(spark: SparkSession, table_dir: str, days=None, version: int | None = None) -> DataFrame:
    """(pricedate, bucket, bits, fresh) of the days at a version."""
    return _read_days(spark, table_dir, "nodes", NODE_SETS, days, version).select("pricedate", "bucket", "bits", "fresh")


def table_nodes(spark: SparkSession, table_dir: str, days=None, version: int | None = None) -> DataFrame:
    """(pricedate, node_id): the table's nodes (S9), from the node sets alone."""
    return members(read_node_sets(spark, table_dir, days, version), words("bits"))


def table_carried_over(spark: SparkSession, table_dir: str, days=None, version: int | None = None) -> DataFrame:
    """(pricedate, node_id): nodes that kept their rows when their day was last merged, for want of new ones."""
    return members(read_node_sets(spark, table_dir, days, version), minus("bits", "fresh"))


def read_nodes(spark: SparkSession, table_dir: str, spec: FeedSpec, nodes: list[int], version: int | None = None) -> DataFrame:
    """Rows of a few nodes on all days (P7). The node sets name the days that have one of them; no file of another day
    is opened. The list of days is bounded by the calendar."""
    at = latest_version(spark, table_dir) if version is None else version
    held = read_node_sets(spark, table_dir, version=at).where(holds_any(nodes)).select("pricedate").distinct().collect()
    return read_versioned(spark, table_dir, spec, [r[0] for r in held], at).where(F.col("node_id").isin(nodes))


def _commit(files: Files, version: int, manifest: dict[str, str]) -> bool:
    """Make the manifest appear under its number, whole, if the number is free."""
    draft = f"_manifest/_draft-{uuid.uuid4().hex}"
    files.create(draft, json.dumps(manifest, sort_keys=True))
    try:
        return files.move(draft, f"_manifest/{version}")
    finally:
        files.delete(draft)


def merge_versioned(spark: SparkSession, table_dir: str, new: DataFrame, spec: FeedSpec, policy: str = "sequence") -> int:
    """Upsert ``new`` rows and publish the days they touch together; returns the version that has them.

    A replayed merge publishes the same rows again. With the ``sequence`` policy the outcome of several writers
    doesn't depend on which of them commits first."""
    files, cols = Files(spark, table_dir), lake_columns(spec)
    new = new.select(*cols)
    fresh = reliable_checkpoint(node_sets(new))
    days = [r[0] for r in fresh.select("pricedate").distinct().collect()]  # bounded by the calendar
    if not days:
        return latest_version(spark, table_dir)
    for _ in range(TRIES):
        before = latest_version(spark, table_dir)
        existing = read_versioned(spark, table_dir, spec, days, before)
        folder = f"v={before + 1}-{uuid.uuid4().hex[:12]}"
        out = merge_rows(existing, new, KEY_COLUMNS, SEQ_COL, policy)
        (out.repartitionByRange("pricedate", "node_id").sortWithinPartitions("pricedate", "node_id", "utcbegin")
            .write.options(**NODE_BLOOM).option("compression", "zstd").partitionBy("pricedate").parquet(f"{table_dir.rstrip('/')}/versions/{folder}"))
        _write_node_sets(read_node_sets(spark, table_dir, days, before), fresh, f"{table_dir.rstrip('/')}/nodes/{folder}")
        manifest = {**read_manifest(spark, table_dir, before), **{_day_name(d): folder for d in days}}
        if _commit(files, before + 1, manifest):
            return before + 1
        for sub in ("versions", "nodes"):  # another writer was first
            files.delete(f"{sub}/{folder}", whole=True)
    raise RuntimeError(f"{TRIES} other writers were faster at {table_dir}")


def _write_node_sets(before: DataFrame, fresh: DataFrame, folder: str) -> None:
    both = before.select("pricedate", "bucket", "bits", F.lit(None).cast("binary").alias("fresh")) \
        .unionByName(fresh.withColumn("fresh", F.col("bits")))
    both.groupBy("pricedate", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.bitmap_or_agg("fresh").alias("fresh")) \
        .repartitionByRange("pricedate", "bucket").sortWithinPartitions("pricedate", "bucket") \
        .write.option("compression", "zstd").partitionBy("pricedate").parquet(folder)


def history(spark: SparkSession, table_dir: str) -> DataFrame:
    """(version, pricedate, folder): the days of every version that is kept."""
    rows = [(v, None if d == NULL_DAY else d, f) for v in sorted(int(n) for n in Files(spark, table_dir).names("_manifest") if n.isdigit())
            for d, f in read_manifest(spark, table_dir, v).items()]
    return spark.createDataFrame(rows, "version long, pricedate string, folder string") \
        .withColumn("pricedate", F.col("pricedate").cast("date"))


def vacuum(spark: SparkSession, table_dir: str, keep: int = 10) -> int:
    """Remove manifests before the last ``keep`` and the days that only they name; returns the number of folders that went.
    A merge that is under way (a folder of a version above the newest) is left alone."""
    files = Files(spark, table_dir)
    numbers = sorted(int(n) for n in files.names("_manifest") if n.isdigit())
    kept = {v: read_manifest(spark, table_dir, v) for v in numbers[-keep:]}
    used = {(folder, day) for m in kept.values() for day, folder in m.items()}
    gone = 0
    for v in numbers[:-keep]:
        files.delete(f"_manifest/{v}")
    for sub in ("versions", "nodes"):
        for folder in files.names(sub):
            if int(folder[2:].split("-")[0]) > numbers[-1]:
                continue
            for name in files.names(f"{sub}/{folder}"):
                if name.startswith("pricedate=") and (folder, name[len("pricedate="):]) not in used:
                    files.delete(f"{sub}/{folder}/{name}", whole=True)
                    gone += sub == "versions"
            if not any(f == folder for f, _ in used):
                files.delete(f"{sub}/{folder}", whole=True)
    return gone
