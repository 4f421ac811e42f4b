"""Structured Streaming jobs (T1-T7, S11): intake merges and the message loop.

The intake folder is a file-stream source; the checkpoint holds which files
are done, and one consuming stream may archive them (the reference deletes
merged files). Each micro-batch is merged with ``foreachBatch`` into the day
table and/or the serving table. Late rows are never dropped: the state of
the merge is the table itself, so no watermark bounds it. A replayed
micro-batch rewrites the same rows. ``start_control_stream`` runs the
worker's whole fetch/merge loop from queue messages.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from lmplake.feeds import FeedSpec
from lmplake.functions.messages import decode_messages, rejected_messages
from lmplake.operators.pulls import coalesce_merge_requests, release_requests
from lmplake.sinks.lake import merge_into_day_table, record_processed, serving_table_path, upsert_serving
from lmplake.sources.intake import intake_schema, lake_schema, narrow_columns, wide_schema


def intake_stream(spark: SparkSession, intake_dir: str, spec: FeedSpec, max_files_per_trigger: int | None = None,
                  archive_dir: str | None = None) -> DataFrame:
    """The intake as a file stream. With ``archive_dir`` Spark moves each file
    there once its micro-batch has committed (K4: consumed inputs leave the
    intake, so listing stays small) - only for a single consumer."""
    r = spark.readStream.schema(wide_schema(intake_schema(spec)))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return r.parquet(intake_dir).select(*narrow_columns(lake_schema(spec)), F.col("_metadata.file_path").alias("file_path"))


def start_day_merge(spark: SparkSession, intake_dir: str, table_dir: str, checkpoint: str, spec: FeedSpec,
                    ledger_dir: str | None = None, available_now: bool = True,
                    max_files_per_trigger: int | None = None, processing_time: str = "1 minute",
                    policy: str = "sequence", serving_root: str | None = None, assets: DataFrame | None = None,
                    archive_dir: str | None = None):
    """Stream intake -> day table (T3). ``available_now`` drains what is
    there and stops; otherwise polls every ``processing_time`` (T2). With
    ``serving_root`` and ``assets`` the same micro-batch also upserts the
    serving table, so one consumer owns the intake and ``archive_dir`` is safe.

    The merge order is ``sequence``: the largest ``ingest_seq`` (stamped at
    landing, growing with every landing) wins, so the result does not depend
    on how files are cut into micro-batches, and a later landing still
    replaces earlier rows."""
    def merge_batch(df: DataFrame, batch_id: int) -> None:
        # The batch is used three times (touched days, merge, ledger): read the
        # files once. Lost blocks are recomputed from the intake files.
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            merge_into_day_table(spark, table_dir, df, spec, policy)
            if serving_root is not None and assets is not None:
                upsert_serving(spark, serving_table_path(serving_root, spec), df, assets, spec, policy)
            if ledger_dir:
                record_processed(df, ledger_dir, batch_id)
        finally:
            df.unpersist()

    w = (intake_stream(spark, intake_dir, spec, max_files_per_trigger, archive_dir).writeStream
         .foreachBatch(merge_batch).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def start_serving_upsert(spark: SparkSession, intake_dir: str, serving_dir: str, checkpoint: str,
                         spec: FeedSpec, assets: DataFrame, available_now: bool = True,
                         max_files_per_trigger: int | None = None, processing_time: str = "1 minute",
                         policy: str = "sequence"):
    """Stream intake -> serving table for known assets (T4), ``sequence``
    order as in ``start_day_merge``."""
    def upsert_batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            upsert_serving(spark, serving_dir, df, assets, spec, policy)
        finally:
            df.unpersist()

    w = (intake_stream(spark, intake_dir, spec, max_files_per_trigger).writeStream
         .foreachBatch(upsert_batch).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def control_message_stream(spark: SparkSession, message_dir: str, envelope: bool = False) -> DataFrame:
    """Text files of queue messages, one per line, below ``message_dir`` (releases
    have folders of their own), decoded (S11, C11, C12)."""
    lines = spark.readStream.schema("value string").option("recursiveFileLookup", "true").text(message_dir)
    return decode_messages(lines, envelope=envelope)


def start_pending_merges(messages: DataFrame, out_dir: str, checkpoint: str, available_now: bool = True,
                         processing_time: str = "1 minute"):
    """Merge requests coalesced within each micro-batch (T5): one row per (feed, day) and
    batch, in ``out_dir/batch_id=N``. A request for an older day counts like any other,
    and a day that is asked for again later is merged again. A repeated batch replaces
    its own folder."""
    def coalesce_batch(df: DataFrame, batch_id: int) -> None:
        coalesce_merge_requests(df).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}")

    w = messages.writeStream.foreachBatch(coalesce_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


#: What may happen to a (feed, day): somebody asks for its merge, or a merge of it has ended.
REQUESTED, FINISHED = "requested", "finished"
IDLE, RUNNING, RUN_AGAIN = 0, 1, 2
MERGE_ACTIONS = "feed string, merge_date date, action string, n_requests long"


def merge_actions(events: DataFrame) -> DataFrame:
    """Merges to start, remembered across micro-batches (T5): ``events`` has feed, merge_date and what.

    Each (feed, day) is idle, running, or running with a wish to run again. A request starts an idle day
    (``start``); while its merge runs, requests are noted once, however many come; when the merge has finished,
    a noted wish starts it once more (``rerun``), else the day is idle again. In one micro-batch what has finished counts
    before what is requested, so no request is taken for one that the finished merge has seen. ``n_requests`` are those
    that the start answers. A row without feed or day is ignored."""
    def step(key, parts, state):
        status, noted = state.get if state.exists else (IDLE, 0)
        asked, done = 0, False
        for pdf in parts:
            asked += int((pdf["what"] == REQUESTED).sum())
            done |= bool((pdf["what"] == FINISHED).any())
        out = []
        if done and status == RUN_AGAIN:
            out.append(("rerun", noted))
            status, noted = RUNNING, 0
        elif done:
            status = IDLE
        if asked and status == IDLE:
            out.append(("start", asked))
            status, noted = RUNNING, 0
        elif asked:
            status, noted = RUN_AGAIN, noted + asked
        state.update((status, noted))
        import pandas as pd
        yield pd.DataFrame([(*key, a, n) for a, n in out], columns=["feed", "merge_date", "action", "n_requests"])

    known = events.where("feed is not null and merge_date is not null").select("feed", "merge_date", "what")
    return known.groupBy("feed", "merge_date").applyInPandasWithState(
        step, MERGE_ACTIONS, "status int, noted long", "append", GroupStateTimeout.NoTimeout)


def start_merge_actions(events: DataFrame, out_dir: str, checkpoint: str, available_now: bool = True,
                        processing_time: str = "1 minute"):
    """``merge_actions`` to ``out_dir/batch_id=N``; a repeated batch replaces its own folder."""
    def put(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}")

    w = merge_actions(events).writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def start_control_stream(spark: SparkSession, message_dir: str, checkpoint: str, lake_root: str,
                         source_options: dict[str, dict], assets: DataFrame, now=None,
                         available_now: bool = True, processing_time: str = "1 minute",
                         consume: str = "keep", envelope: bool = False, release: bool = False):
    """The worker's message loop as one stream over queue messages (S11, K7,
    T1-T5). Each micro-batch is decoded once and then:

    * fetch messages -> ``run_fetch_cycle`` per feed (landing id claimed below ``<root>/_landings``,
      so that it grows over new checkpoints too):
      pages land in ``<root>/<feed>/intake``, known assets are upserted into
      ``<root>/serving/<target>``, next requests go to ``<root>/requests``;
    * merge messages -> the named days of each feed are swept from its intake
      into ``<root>/<feed>/day`` (ledger ``<root>/<feed>/ledger``; merged
      files kept, archived to ``<root>/<feed>/archive`` or deleted per
      ``consume``);
    * anything else, and messages for feeds that have no transport here ->
      ``<root>/quarantine/messages/batch_id=N`` (N: the landing id).

    With ``release``, each micro-batch ends by turning the requests that are due by then into messages
    below ``message_dir`` (K7), which the next micro-batch takes up.

    All outputs of a batch go to folders of that batch (or are upserts), so a batch
    that is repeated after a failure replaces what its first attempt left.

    The pull key of a fetch is its begin time as ``yyyyMMddTHHmm``. ``now``
    (a datetime, or a callable giving one per batch) prices the next
    requests' delays; by default the batch's start time."""
    import datetime as dt

    from pyspark.sql import functions as F

    from lmplake.feeds import feed as feed_spec
    from lmplake.functions.time_cols import pull_key
    from lmplake.plans.cycle import run_fetch_cycle
    from lmplake.sinks.lake import sweep_intake
    from lmplake.sinks.landings import claim_landing, query_name
    from lmplake.sources.paths import exists

    root = lake_root.rstrip("/")

    def handle(batch: DataFrame, batch_id: int) -> None:
        msgs = batch.persist(StorageLevel.MEMORY_AND_DISK)  # filters below must not re-parse the JSON
        try:
            at = now() if callable(now) else (now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
            kinds = {r.kind: r.n for r in msgs.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
            configured = list(source_options)
            if not kinds:
                return
            landing = claim_landing(spark, f"{root}/_landings", f"{query_name(spark, checkpoint)}/{batch_id}")
            if kinds:
                rejected_messages(msgs, configured).select("value").write.mode("overwrite") \
                    .text(f"{root}/quarantine/messages/batch_id={landing}")
            if kinds.get("fetch"):
                fetch = msgs.where((F.col("kind") == "fetch") & F.col("feed").isin(configured)).select(
                    "feed", pull_key("begin_utc").alias("pull"), "begin_utc", "queue_next")
                for (name,) in fetch.select("feed").distinct().collect():  # at most the known feeds
                    run_fetch_cycle(spark, fetch, name, source_options[name], f"{root}/{name}/intake",
                                    f"{root}/serving", assets, landing_id=landing, now=at,
                                    requests_out=f"{root}/requests", quarantine_dir=f"{root}/quarantine/{name}")
            if kinds.get("merge"):
                wanted = msgs.where(F.col("kind") == "merge") \
                    .select("feed", "merge_date").distinct().collect()  # bounded by feeds x days
                by_feed: dict[str, list] = {}
                for r in wanted:
                    by_feed.setdefault(r.feed, []).append(r.merge_date)
                for name, days in by_feed.items():
                    if name in source_options:
                        sweep_intake(spark, f"{root}/{name}/intake", f"{root}/{name}/day",
                                     f"{root}/{name}/ledger", feed_spec(name), landing, days,
                                     consume=consume, archive_dir=f"{root}/{name}/archive")
            if release and exists(f"{root}/requests"):
                release_requests(spark, f"{root}/requests", message_dir, f"{root}/released", at, landing)
        finally:
            msgs.unpersist()

    w = control_message_stream(spark, message_dir, envelope).writeStream.foreachBatch(handle) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
