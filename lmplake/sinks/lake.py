"""Lake writers (K1-K5): intake landing, day-table merge, serving upsert,
processed-file ledger.

Publishing is staged, like the reference's ``_processing`` copy (K3): the
merged days are first written in full to ``<table>/_staging/<id>`` (Spark
ignores ``_`` folders when reading the table), then the touched days are
replaced from there with Spark's dynamic partition overwrite, the staging
folder (marked ``_COMPLETE`` before that) is marked ``_PUBLISHED`` and removed. So (a) the overwrite never reads
files it is replacing, (b) a lost executor recomputes from the staged files,
and (c) if the driver dies in the middle of the overwrite's commit - old day
folder deleted, new one not yet moved in - the next merge finds the complete
staged copy and publishes it again before doing anything else. Replaying a
batch gives the same table, so a retried job is safe.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lmplake.session import reliable_checkpoint, ship_package

from lmplake.feeds import KEY_COLUMNS, FeedSpec
from lmplake.operators.merge import SEQ_COL, merge_rows, touched_days
from lmplake.operators.serve import asset_lookup, asset_upsert, serving_columns, serving_schema
from lmplake.sources.intake import intake_files, lake_schema, read_intake_files, scan_day_table
from lmplake.sources.paths import day_folders, fs_for, newest, sub_dirs
from lmplake.sources.paths import exists as _exists
from lmplake.sources.paths import remove_dir as _remove
from lmplake.sources.paths import touch as _touch


def lake_columns(spec: FeedSpec) -> list[str]:
    return [f.name for f in lake_schema(spec).fields]


ROW_BITS = 32  # rows per pull stay below 2**32


MAX_LANDING = (1 << 30) - 1  # the merge order keeps its top two bits for the source rank


def stamp_ingest_seq(df: DataFrame, landing_id: int | Column, row_col: str = "api_row") -> DataFrame:
    """Stamp the total merge order at landing: ``landing_id << 32 | row``.
    ``landing_id`` grows with every landing of the lake (``landings.claim_landing``)
    and stays below 2**30; ``row_col`` is the row's place in the landing
    (below 2**32), so "last" among new rows is the API's order, never file listing
    order. Values out of range fail loudly. Replays keep the stamp."""
    if not isinstance(landing_id, Column):
        if not 0 <= int(landing_id) <= MAX_LANDING:
            raise ValueError(f"landing_id {landing_id} is not in 0..{MAX_LANDING}: use a counter, not a clock")
        landing_id = F.lit(int(landing_id))
    lid, row = landing_id.cast("bigint"), F.col(row_col).cast("bigint")
    wrong = (lid < 0) | (lid > MAX_LANDING) | (row < 0) | (row >= F.lit(1 << ROW_BITS))
    seq = F.shiftleft(lid, ROW_BITS) + row
    return df.withColumn(SEQ_COL, F.when(wrong, F.raise_error(F.lit("landing id or row number out of range")).cast("bigint"))
                         .otherwise(seq))


def order_pulls(rows: DataFrame, requests: DataFrame, pull_col: str = "pull", begin_col: str = "begin_utc",
                row_col: str = "api_row", out_col: str = "cycle_row") -> DataFrame:
    """Append each row's place in the whole cycle: pulls stand one after the other by
    their begin time, so a row of a later pull beats every row of an earlier one where
    their windows overlap, and the API's order decides inside a pull. The running sum
    goes over one row for each pull of the cycle (one request message each)."""
    from pyspark.sql import Window
    size = rows.groupBy(pull_col).agg(F.max(row_col).alias("_rows"))
    begin = requests.groupBy(pull_col).agg(F.min(begin_col).alias("_begin"))
    before = Window.orderBy("_begin", pull_col).rowsBetween(Window.unboundedPreceding, -1)
    offsets = begin.join(size, pull_col).select(
        pull_col, F.coalesce(F.sum(F.col("_rows") + 1).over(before), F.lit(0)).alias("_offset"))
    return rows.join(offsets, pull_col).withColumn(out_col, F.col("_offset") + F.col(row_col)).drop("_offset")


def land_intake(df: DataFrame, intake_dir: str, spec: FeedSpec, landing: int | None = None) -> None:
    """Land rows in the feed's intake, one folder per market day and landing.

    With ``landing`` (a number of ``sinks/landings.py``) a repeated landing replaces its own
    folders, so a retried batch leaves no second copy; without it rows are appended. The
    landing's days are noted below ``_landed`` before any row is written, so a retry that
    yields other days removes the folders of the first try.

    Range partitioning on (day, node, ingest_seq) keeps each task on a few day
    folders - about tasks + days files per landing instead of tasks x days -
    and, because ``ingest_seq`` is unique, splits even a key that repeats a
    billion times over many writers. A key's rows may therefore sit in several
    files and micro-batches; the streaming merge uses the ``sequence`` order
    (largest stamped sequence wins), which does not depend on that split."""
    out = df.select(*lake_columns(spec)).withColumn("landing", F.lit(0 if landing is None else int(landing)).cast("bigint"))
    w = out.repartitionByRange("pricedate", "node_id", SEQ_COL).write.partitionBy("pricedate", "landing")
    if landing is None:
        w.mode("append").parquet(intake_dir)
    else:
        root, number = intake_dir.rstrip("/"), int(landing)
        note = f"{root}/_landed/{number}"
        before = {d.rsplit("=", 1)[-1] for d in sub_dirs(note)}
        days = {"__HIVE_DEFAULT_PARTITION__" if r[0] is None else r[0].isoformat()  # bounded by the calendar
                for r in out.select("pricedate").distinct().collect()}
        for d in days - before:
            _touch_in(f"{note}/day={d}")
        w.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(intake_dir)
        for d in before - days:
            _remove(f"{root}/pricedate={d}/landing={number}")
            _remove(f"{note}/day={d}")


def _touch_in(folder: str) -> None:
    fsys, p = fs_for(folder)
    fsys.create_dir(p, recursive=True)


NODE_BLOOM = {"parquet.bloom.filter.enabled#node_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def write_day_partitions(df: DataFrame, table_dir: str, day_col: str = "pricedate") -> None:
    """Replace exactly the days present in ``df``. Range partitioning on
    (day, node) splits a big day over several tasks and keeps each file's
    nodes contiguous; files are sorted by (node, time) so Parquet min/max
    statistics prune row groups for node lookups. Each row group carries a Bloom filter
    of its nodes, sized by the nodes it holds, so a lookup without a day skips the days
    that lack the node although their range spans it."""
    (df.repartitionByRange(day_col, "node_id")
       .sortWithinPartitions(day_col, "node_id", "utcbegin")
       .write.mode("overwrite")
       .options(**NODE_BLOOM)
       .option("partitionOverwriteMode", "dynamic")
       .option("compression", "zstd")
       .partitionBy(day_col)
       .parquet(table_dir))


STALE_SECONDS = 24 * 3600


def _staged_dirs(table_dir: str) -> list[str]:
    return sub_dirs(f"{table_dir.rstrip('/')}/_staging")


def publish_staged(spark: SparkSession, merged: DataFrame, table_dir: str, layout) -> None:
    """Write ``merged`` to a staging folder and mark it ``_COMPLETE``, replace its days in
    the table with ``layout(df, table_dir)``, mark and remove the staging folder."""
    stage = f"{table_dir.rstrip('/')}/_staging/{spark.sparkContext.applicationId}_{uuid.uuid4().hex}"
    merged.write.mode("errorifexists").parquet(stage)
    _touch(f"{stage}/_COMPLETE")  # our own mark: Hadoop's _SUCCESS may be switched off
    _republish(spark, stage, table_dir, layout)


def _republish(spark: SparkSession, stage: str, table_dir: str, layout) -> None:
    layout(spark.read.parquet(stage), table_dir)
    _touch(f"{stage}/_PUBLISHED")
    _remove(stage)


def recover_staged(spark: SparkSession, table_dir: str, layout, stale_seconds: float = STALE_SECONDS) -> int:
    """Finish publishes a crashed driver left behind; returns how many were
    published again. A staging folder with ``_COMPLETE`` but no ``_PUBLISHED``
    holds complete merged days and is published again (idempotent). One without
    ``_COMPLETE`` never touched the table: it is removed when it is this
    application's or has not changed for ``stale_seconds``; else another writer may
    be staging right now, and it is left alone."""
    import time
    redone, own = 0, spark.sparkContext.applicationId + "_"
    for stage in _staged_dirs(table_dir):
        if _exists(f"{stage}/_PUBLISHED"):
            _remove(stage)
        elif _exists(f"{stage}/_COMPLETE"):
            _republish(spark, stage, table_dir, layout)
            redone += 1
        elif stage.rsplit("/", 1)[-1].startswith(own) or time.time() - newest(stage) > stale_seconds:
            _remove(stage)
    return redone


def merge_into_day_table(spark: SparkSession, table_dir: str, new: DataFrame, spec: FeedSpec,
                         policy: str = "arrival") -> list:
    """Upsert ``new`` rows into the day table; returns the touched days.

    The touched-day list is the one driver-side collection: it is bounded by
    the calendar (distinct market days), not by the data, and it becomes a
    partition filter so only those day folders are read."""
    recover_staged(spark, table_dir, write_day_partitions)
    cols = lake_columns(spec)
    new = new.select(*cols)
    days = [r[0] for r in touched_days(new).collect()]
    if not days:
        return []
    existing = scan_day_table(spark, table_dir, spec, days).select(*cols)
    publish_staged(spark, merge_rows(existing, new, KEY_COLUMNS, SEQ_COL, policy), table_dir, write_day_partitions)
    return days


def serving_table_path(serving_root: str, spec: FeedSpec) -> str:
    """Serving table of a feed, chosen by its declared target (K6): day-ahead
    and real-time prices live in separate tables, as they do in the reference's
    database, without looking at which columns a frame has."""
    return f"{serving_root.rstrip('/')}/{spec.serving_target}"


def upsert_serving(spark: SparkSession, serving_dir: str, prices: DataFrame, assets: DataFrame,
                   spec: FeedSpec, policy: str = "arrival") -> list:
    """Serving upsert for known assets: broadcast lookup, latest wins on
    (node, utcbegin) against the touched days, dynamic overwrite."""
    recover_staged(spark, serving_dir, _write_serving)
    batch = asset_lookup(prices, assets, spec, keep=(SEQ_COL,))
    days = [r[0] for r in batch.select("pricedate").distinct().collect()]
    if not days:
        return []
    cols = [*serving_columns(spec), SEQ_COL]
    serving = None
    folders = day_folders(serving_dir, days)  # only the touched days are listed and read
    if folders:
        serving = spark.read.schema(serving_schema(spec)).option("basePath", serving_dir) \
            .parquet(*folders).select(*cols)
    publish_staged(spark, asset_upsert(serving, batch, spec, policy=policy), serving_dir, _write_serving)
    return days


def _write_serving(df: DataFrame, serving_dir: str) -> None:
    (df.repartitionByRange("pricedate", "node")
       .sortWithinPartitions("pricedate", "node", "utcbegin")
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("pricedate").parquet(serving_dir))


def record_processed(files: DataFrame, ledger_dir: str, batch_id: int | None = None) -> None:
    """Append merged intake files to the ledger (never delete before publish)."""
    out = files.select("file_path").distinct()
    if batch_id is not None:
        out = out.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
    out.write.mode("append").parquet(ledger_dir)


#: Pending files that a sweep merges at once (their paths pass through the driver).
SWEEP_FILES = 100_000


def _waves(counts: list[tuple[str, int]], limit: int) -> list[tuple[str, str]]:
    """Cut day folders, in order, into ranges (first, last) of at most ``limit`` files, one folder at least."""
    out, held = [], 0
    for folder, n in counts:
        if out and held + n <= limit:
            out[-1], held = (out[-1][0], folder), held + n
        else:
            out.append((folder, folder))
            held = n
    return out


def sweep_intake(spark: SparkSession, intake_dir: str, table_dir: str, ledger_dir: str, spec: FeedSpec,
                 batch_id: int | None = None, days=None, consume: str = "keep",
                 archive_dir: str | None = None) -> list:
    """Batch form of the streaming merge (T7): merge every landed file that
    the ledger does not list yet (only of ``days`` when given, as a merge
    message asks), then record those files. Files are chosen by an anti-join
    against the ledger, so a rerun after a failure merges the same files again
    (idempotent) and a rerun after success merges nothing.

    The pending paths are a checkpointed table. They are merged in waves of whole days with at most ``SWEEP_FILES``
    files (a day with more is a wave), each published and recorded before the next, so a backlog of any
    length passes through in parts, and a sweep that dies goes on behind its last wave.

    ``consume`` (K4): ``keep`` the merged files, ``archive`` them under
    ``archive_dir`` (same relative path) or ``delete`` them - always after the
    publish and after the ledger write, so a crash in between leaves files the
    ledger already excludes."""
    if consume not in ("keep", "archive", "delete") or (consume == "archive" and not archive_dir):
        raise ValueError(f"consume={consume!r} (archive needs archive_dir)")
    if not _exists(intake_dir):
        return []
    files = intake_files(spark, intake_dir, days)
    if _exists(ledger_dir):
        done = spark.read.schema("file_path string, batch_id bigint").parquet(ledger_dir).select("file_path")
        files = files.join(done, "file_path", "left_anti")
    # pinned once: what lands from here on is the next sweep's
    pending = reliable_checkpoint(files.distinct().withColumn("folder", F.regexp_extract("file_path", "/pricedate=([^/]+)/", 1)))
    counts = [tuple(r) for r in pending.groupBy("folder").count().orderBy("folder").collect()]  # a row a day
    merged = []
    for first, last in _waves(counts, SWEEP_FILES):
        listed = pending.where(F.col("folder").between(first, last)).select("file_path")
        paths = sorted(r[0] for r in listed.collect())
        touched = merge_into_day_table(spark, table_dir, read_intake_files(spark, intake_dir, paths, spec), spec)
        if touched:
            record_processed(listed, ledger_dir, batch_id)
            if consume != "keep":
                _consume_files(listed, intake_dir, consume, archive_dir)
        merged.extend(touched)
    return merged


def _consume_files(listed: DataFrame, intake_dir: str, consume: str, archive_dir: str | None) -> None:
    """Archive or delete the merged intake files, in tasks: each takes some of the paths.
    A file that is gone was consumed by an earlier attempt of its task."""
    from urllib.parse import unquote, urlparse

    def plain(p: str) -> str:
        u = urlparse(p)
        return unquote(u.path) if u.scheme == "file" else unquote(p)

    root = plain(intake_dir if "://" in intake_dir else "file://" + os.path.abspath(intake_dir))

    def run(batches):
        import pyarrow as pa

        from lmplake.sources.paths import delete_file, exists, move
        for b in batches:
            n = 0
            for path in b.column(0).to_pylist():
                src = plain(path)
                if not exists(src):
                    continue
                if consume == "delete":
                    delete_file(src)
                else:
                    move(src, f"{archive_dir.rstrip('/')}/{os.path.relpath(src, root)}")
                n += 1
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    ship_package(listed.sparkSession)
    listed.select("file_path").mapInArrow(run, "n bigint").agg(F.sum("n")).collect()
