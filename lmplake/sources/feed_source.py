"""Paged price feeds as a Spark Python Data Source.

Planning runs on the driver and only touches headers: for every requested
pull it asks the transport for the row-count header and emits one input
partition per page (``start_row`` 1, 1 + page, ...). Executors fetch and
decode the pages in parallel, so a pull of many pages is read by many tasks.

The transport is injected (``transport`` option, ``module:Class``). The
network client of a live deployment is one implementation; the built-in
``PageFolderTransport`` serves pages that Spark wrote to a folder, read
through ``pyarrow.fs`` so the folder may be on any shared file system.

The source only moves bytes: it yields one row per page, ``(pull,
start_row, expected_rows, page_text)``. Decoding happens in the JVM
(``parse_feed_pages``: ``from_json`` + ``posexplode``), where a page whose
record count differs from its header fails the job (``raise_error``), as a
pull with a bad page must not land half.

Batch:  ``read_feed(spark, options)``; a plan of named pulls reads the headers of these only.
Stream: ``read_feed_stream(spark, options)`` - the offset is the last entry of
the transport's header log that was handed out; each micro-batch takes the pulls
that the log lists since (T1), in whatever key order they arrive. A pull whose
header says 0 rows is not done: it is handed out when a later entry gives it rows,
and an unchanged offset means "poll again later" (T2). With ``max_pages_per_batch``
a micro-batch is planned with at most that many pages (a larger pull stands alone), the rest
of the log is left to the next ones, and an offset may lie inside a landing.
"""

from __future__ import annotations

import importlib
import json
import math
import zlib

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from lmplake.feeds import PAGE_SIZE, feed
from lmplake.sources.paths import fs_for


#: Entries in a bucket of the header log, on average.
BUCKET_ENTRIES = 1024
#: Landings behind the newest snapshot at which the log is compacted.
SNAPSHOT_EVERY = 16


def header_bucket(pull: str, buckets: int) -> int:
    return zlib.crc32(pull.encode("utf-8")) % buckets


class PageFolderTransport:
    """Pages under ``{root}/feed=F/pull=P/start_row=N/`` (text files, one JSON
    array per line) and a header log under ``{root}/_headers``: one folder
    ``landing=N`` for each landing, with JSON lines ``feed, pull, total_rows`` of the
    pulls that are new or changed, and a ``_COMPLETE`` mark.

    A landing is cut into buckets by the CRC-32 of the pull, some ``BUCKET_ENTRIES`` entries
    each (``feed=F/bucket=b/``; the mark tells their number). Every ``SNAPSHOT_EVERY`` landings the
    latest header of each pull goes to a snapshot ``_snapshots/F/upto=N``, cut alike. So the
    headers of k pulls are at most k buckets of the snapshot and of each landing behind it,
    however long the log is. Landings stay: a stream replays from them.

    A transport has four methods: ``headers(feed) -> {pull: total_rows}`` (the
    latest of each pull), ``log_end(feed) -> token`` and ``log_between(feed, after,
    until) -> {pull: total_rows}`` (entries behind ``after``, up to ``until``; tokens are
    strings that sort in log order, "" is before the first) and
    ``fetch_page_text(feed, pull, start_row, row_count, fields) -> str``. It may have
    ``headers_of(feed, pulls)`` for plans of named pulls, and ``log_entries(feed, after)`` for
    streams with a limit."""

    def __init__(self, options: dict):
        root = options["root"].rstrip("/")
        if root.startswith("file:") and not root.startswith("file://"):
            root = "/" + root[len("file:"):].lstrip("/")
        self.root = root
        self.opened = 0

    def _fs(self):
        from pyarrow import fs
        return fs.FileSystem.from_uri(self.root)

    def _lines(self, path: str):
        from pyarrow import fs as pafs
        fsys, base = self._fs()
        sub = base + path[len(self.root):]
        infos = fsys.get_file_info(pafs.FileSelector(sub, allow_not_found=True))
        for info in sorted(infos, key=lambda i: i.path):
            name = info.path.rsplit("/", 1)[-1]
            if info.type != pafs.FileType.File or name.startswith((".", "_")):
                continue
            self.opened += 1
            with fsys.open_input_stream(info.path) as f:
                for line in f.read().decode("utf-8").splitlines():
                    if line.strip():
                        yield line

    def _folders(self, path: str, prefix: str) -> list[str]:
        """Names behind ``prefix`` of the sub-folders, in order."""
        from pyarrow import fs as pafs
        fsys, base = self._fs()
        infos = fsys.get_file_info(pafs.FileSelector(base + path[len(self.root):], allow_not_found=True))
        return sorted(i.base_name[len(prefix):] for i in infos
                      if i.type == pafs.FileType.Directory and i.base_name.startswith(prefix))

    def _mark(self, folder: str) -> dict | None:
        """What the ``_COMPLETE`` mark of a folder tells; None without one."""
        from pyarrow import fs as pafs
        fsys, base = self._fs()
        path = f"{base}{folder[len(self.root):]}/_COMPLETE"
        if fsys.get_file_info(path).type == pafs.FileType.NotFound:
            return None
        with fsys.open_input_stream(path) as f:
            return json.loads(f.read() or b"{}")

    def snapshot(self, feed_name: str) -> tuple[str, int]:
        """(last landing in it, buckets) of the newest complete snapshot; ("", 0) without one."""
        folder = f"{self.root}/_headers/_snapshots/{feed_name}"
        for upto in reversed(self._folders(folder, "upto=")):
            mark = self._mark(f"{folder}/upto={upto}")
            if mark is not None:
                return upto, mark["buckets"]
        return "", 0

    def landings(self, after: str = "", itself: bool = False) -> list[tuple[str, dict]]:
        """Complete landings behind ``after`` (or with it) and their marks, in order, up to the first one that is still
        being written."""
        out = []
        for landing in self._folders(f"{self.root}/_headers", "landing="):
            if landing > after or (itself and landing == after):
                mark = self._mark(f"{self.root}/_headers/landing={landing}")
                if mark is None:
                    break
                out.append((landing, mark))
        return out

    def _buckets(self, landing: str, mark: dict, feed_name: str) -> list[str]:
        """The folders of a landing's buckets; a landing without buckets is one."""
        folder = f"{self.root}/_headers/landing={landing}"
        if "buckets" not in mark:
            return [folder]
        return [f"{folder}/feed={feed_name}/bucket={b}" for b in range(mark["buckets"].get(feed_name, 0))]

    def _entries(self, folder: str, feed_name: str) -> dict[str, int]:
        found = (json.loads(line) for line in self._lines(folder))
        return {h["pull"]: int(h["total_rows"]) for h in found if h["feed"] == feed_name}

    def log_end(self, feed_name: str) -> str:
        upto, _ = self.snapshot(feed_name)
        behind = self.landings(upto)
        return behind[-1][0] if behind else upto

    def log_between(self, feed_name: str, after: str, until: str) -> dict[str, int]:
        out = {}
        for landing, mark in self.landings(after):
            if landing <= until:
                for folder in self._buckets(landing, mark, feed_name):
                    out.update(self._entries(folder, feed_name))
        return out

    def log_entries(self, feed_name: str, after: dict):
        """(offset, pull, total_rows) of the entries behind an offset, in log order: by landing, bucket and pull.
        A bucket is read when it is reached."""
        start, bucket, entries = after.get("log", ""), after.get("bucket"), after.get("entries", 0)
        inside = bucket is not None
        for landing, mark in self.landings(start, itself=inside):
            here = inside and landing == start
            folders = self._buckets(landing, mark, feed_name)
            for b, folder in enumerate(folders):
                if here and b < bucket:
                    continue
                found = sorted(self._entries(folder, feed_name).items())
                for n, (pull, total) in enumerate(found, 1):
                    if here and b == bucket and n <= entries:
                        continue
                    yield {"log": landing, "bucket": b, "entries": n}, pull, total
            yield {"log": landing}, None, 0

    def headers(self, feed_name: str) -> dict[str, int]:
        return self._latest(feed_name, None)

    def headers_of(self, feed_name: str, pulls) -> dict[str, int]:
        return self._latest(feed_name, set(pulls))

    def _latest(self, feed_name: str, pulls: set | None) -> dict[str, int]:
        upto, buckets = self.snapshot(feed_name)
        folders = [[f"{self.root}/_headers/_snapshots/{feed_name}/upto={upto}/bucket={b}" for b in range(buckets)]]
        folders += [self._buckets(landing, mark, feed_name) for landing, mark in self.landings(upto)]
        out = {}
        for cut in folders:
            wanted = range(len(cut)) if pulls is None else sorted({header_bucket(p, len(cut)) for p in pulls} if cut else ())
            for b in wanted:
                out.update(self._entries(cut[b], feed_name))
        return out if pulls is None else {p: n for p, n in out.items() if p in pulls}

    def headers_frame(self, spark, feed_name: str):
        """The latest header of each pull, read and reduced in Spark: the newest snapshot and the landings behind it."""
        from pyspark.sql import functions as F
        upto, buckets = self.snapshot(feed_name)
        columns = "feed string, pull string, total_rows bigint"
        parts = [(landing, f"{self.root}/_headers/landing={landing}") for landing, _ in self.landings(upto)]
        if buckets:
            parts.append(("", f"{self.root}/_headers/_snapshots/{feed_name}/upto={upto}"))
        log = spark.createDataFrame([], f"{columns}, landing string")
        for landing, path in parts:
            log = log.unionByName(spark.read.schema(columns).option("recursiveFileLookup", "true").json(path)
                                  .withColumn("landing", F.lit(landing)))
        return log.where(F.col("feed") == feed_name).groupBy("pull").agg(F.max_by("total_rows", "landing").alias("total_rows"))

    def fetch_page_text(self, feed_name: str, pull: str, start_row: int, row_count: int, fields: list[str]) -> str:
        """The page body as the API sends it: one JSON array ("[]" if absent)."""
        path = f"{self.root}/feed={feed_name}/pull={pull}/start_row={start_row}"
        texts = list(self._lines(path))
        if len(texts) == 1:
            return texts[0]
        return json.dumps([r for t in texts for r in json.loads(t)])


def load_transport(options: dict):
    spec = options.get("transport")
    if not spec:
        return PageFolderTransport(options)
    mod, _, cls = spec.partition(":")
    return getattr(importlib.import_module(mod), cls)(options)


def named_pulls(options: dict) -> list[str]:
    """The ``pulls`` option: a JSON array of keys, or keys with commas between them."""
    text = options.get("pulls")
    if not text:
        return []
    return json.loads(text) if text.lstrip().startswith("[") else text.split(",")


class PagePartition(InputPartition):
    """Consecutive pages of one pull: ``pages`` is a list of
    ``(start_row, expected_rows)``."""

    def __init__(self, pull: str, pages: list[tuple[int, int]]):
        super().__init__((pull, pages[0][0]))
        self.pull = pull
        self.pages = pages


def _plan_pages(transport, feed_name: str, pulls: list[str], page_size: int,
                pages_per_partition: int = 1) -> list[PagePartition]:
    """Headers are read once per plan; pages are planned from them and
    grouped ``pages_per_partition`` at a time (1 for full 50,000-row pages;
    more when pages are small, so a task is not mostly start-up)."""
    return _cut_pages(_totals(transport, feed_name, pulls), feed_name, pulls, page_size, pages_per_partition)


def _totals(transport, feed_name: str, pulls) -> dict[str, int]:
    """The headers of ``pulls`` (None: of all pulls)."""
    if pulls is not None and hasattr(transport, "headers_of"):
        return transport.headers_of(feed_name, pulls)
    return transport.headers(feed_name)


def _n_pages(total: int, page_size: int) -> int:
    return math.ceil(total / page_size) if total > 0 else 0


def _cut_pages(totals: dict[str, int], feed_name: str, pulls: list[str], page_size: int,
               pages_per_partition: int) -> list[PagePartition]:
    parts = []
    for pull in pulls:
        if pull not in totals:  # no answer is not the same as no rows
            raise ValueError(f"{feed_name} pull {pull} has no row-count header")
        total = totals[pull]
        pages = [(p * page_size + 1, min(page_size, total - p * page_size))
                 for p in range(_n_pages(total, page_size))]
        for i in range(0, len(pages), pages_per_partition):
            parts.append(PagePartition(pull, pages[i:i + pages_per_partition]))
    return parts


PAGE_SCHEMA = "pull string, start_row bigint, expected_rows bigint, page_text string"


class _PageReading:
    def __init__(self, options: dict):
        self.options = dict(options)
        self.feed = self.options["feed"]
        self.page_size = int(self.options.get("page_size", PAGE_SIZE))
        self.fields = list(feed(self.feed).api_fields)
        self.pages_per_partition = max(1, int(self.options.get("pages_per_partition", 1)))

    def read(self, partition: PagePartition):
        """One row per page: the body text and the row count its header
        promised. Decoding and the count check happen in the JVM."""
        t = load_transport(self.options)
        for start_row, expected in partition.pages:
            text = t.fetch_page_text(self.feed, partition.pull, start_row, self.page_size, self.fields)
            yield (partition.pull, start_row, expected, text)


class FeedPagesReader(_PageReading, DataSourceReader):
    """Batch reader."""

    pull_filter: set | None = None

    def partitions(self):
        named = named_pulls(self.options)
        totals = _totals(load_transport(self.options), self.feed, named or self.pull_filter)
        pulls = named or sorted(totals)
        if self.pull_filter is not None:
            pulls = [p for p in pulls if p in self.pull_filter]
        return _cut_pages(totals, self.feed, pulls, self.page_size, self.pages_per_partition)


class FeedPagesPushdownReader(FeedPagesReader):
    """Batch reader that takes ``pull = x`` / ``pull IN (...)`` filters, so
    pages of other pulls are never requested (the API-side window filter).
    Chosen with ``option("pushdown", "true")``; Spark requires
    ``spark.sql.python.filterPushdown.enabled`` for it (and refuses a reader
    with ``pushFilters`` when that is off, hence the separate class)."""

    def pushFilters(self, filters):
        from pyspark.sql.datasource import EqualTo, In
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("pull",):
                keep = {str(f.value)}
            elif isinstance(f, In) and f.attribute == ("pull",):
                keep = {str(v) for v in f.value}
            else:
                yield f
                continue
            self.pull_filter = keep if self.pull_filter is None else self.pull_filter & keep


def _log_order(offset: dict) -> tuple:
    """Offsets in log order: a landing as a whole comes behind all places inside it."""
    whole = "bucket" not in offset
    return (offset.get("log", ""), whole, offset.get("bucket", 0), offset.get("entries", 0))


class Position:
    """The last offset that a limited stream was planned to, kept in a folder of its own: Spark asks for the
    next offset without telling the last one, also after a restart. A new file for each, the newest counts."""

    def __init__(self, folder: str):
        self.folder = folder

    def _files(self):
        from pyarrow import fs as pafs
        fsys, p = fs_for(self.folder)
        found = fsys.get_file_info(pafs.FileSelector(p, allow_not_found=True))
        return fsys, p, sorted(i.base_name for i in found if i.base_name.isdigit())

    def get(self) -> dict:
        fsys, p, names = self._files()
        for name in reversed(names):
            with fsys.open_input_stream(f"{p}/{name}") as f:
                text = f.read()
            if text.endswith(b"\n"):  # written to its end
                return json.loads(text)
        return {"log": ""}

    def set(self, offset: dict) -> None:
        fsys, p, names = self._files()
        fsys.create_dir(p, recursive=True)
        with fsys.open_output_stream(f"{p}/{int(names[-1]) + 1 if names else 1:012d}") as f:
            f.write(json.dumps(offset).encode() + b"\n")
        for name in names[:-1]:  # the one before stays until the new one is known to stand
            fsys.delete_file(f"{p}/{name}")


class FeedCursorStreamReader(_PageReading, DataSourceStreamReader):
    """Offset = last header-log entry handed out. ``start_after`` leaves out the pulls
    up to a key, for a stream that starts in the middle of a feed.

    ``max_pages_per_batch`` limits what a micro-batch takes: entries in log order as long as their pages fit, one
    at least (pulls aren't cut). The reader then keeps its own position in the folder ``position``, which
    belongs to the query's checkpoint and is best put inside it; a position behind the checkpoint fails the query.
    Under ``availableNow`` Spark asks for one offset only, so each run takes one such batch."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.limit = int(self.options.get("max_pages_per_batch", 0))
        if self.limit < 0 or (self.limit and not self.options.get("position")):
            raise ValueError("max_pages_per_batch needs a positive number and the option position")
        self.position = Position(self.options["position"]) if self.limit else None
        self.after = self.options.get("start_after", "")

    def initialOffset(self):
        return {"log": ""}

    def latestOffset(self):
        t = load_transport(self.options)
        if not self.limit:
            return {"log": t.log_end(self.feed)}
        end, pages = self.position.get(), 0
        for offset, pull, total in t.log_entries(self.feed, end):
            more = _n_pages(total, self.page_size) if pull is not None and pull > self.after else 0
            if pages and pages + more > self.limit:
                break
            end, pages = offset, pages + more
        return end

    def partitions(self, start: dict, end: dict):
        t = load_transport(self.options)
        if not self.limit and "bucket" not in start and "bucket" not in end:
            totals = t.log_between(self.feed, start.get("log", ""), end.get("log", ""))
        else:
            if _log_order(end) < _log_order(start):
                raise ValueError(f"the stream's position {end} is behind its checkpoint {start}: restore the position folder")
            totals = {}
            for offset, pull, total in t.log_entries(self.feed, start):
                if _log_order(offset) > _log_order(end):
                    break
                if pull is not None:
                    totals[pull] = total
        if self.limit and _log_order(self.position.get()) < _log_order(end):
            self.position.set(end)
        return _cut_pages(totals, self.feed, sorted(p for p in totals if p > self.after), self.page_size, self.pages_per_partition)

    def commit(self, end: dict):
        pass


class FeedPagesDataSource(DataSource):
    @classmethod
    def name(cls):
        return "lmplake_feed"

    def schema(self):
        return PAGE_SCHEMA

    def reader(self, schema):
        if str(self.options.get("pushdown", "false")).lower() == "true":
            return FeedPagesPushdownReader(self.options)
        return FeedPagesReader(self.options)

    def streamReader(self, schema):
        return FeedCursorStreamReader(self.options)


def parse_feed_pages(pages, feed_name: str, strict: bool = True):
    """Page rows -> records ``(pull, start_row, api_row, <raw fields>)``.
    ``api_row`` is the record's number within its pull (the API's order),
    used to stamp a total merge order at landing. In strict mode (default)
    a page that is missing, malformed or not of its promised size raises."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    spec = feed(feed_name)
    arr = F.from_json(F.col("page_text"), T.ArrayType(spec.raw_schema()))
    if strict:
        msg = F.concat(F.lit(f"{feed_name} pull "), F.col("pull"), F.lit(" page "), F.col("start_row").cast("string"),
                       F.lit(": "), F.coalesce(F.size(arr), F.lit(-1)).cast("string"),
                       F.lit(" rows, header promised "), F.col("expected_rows").cast("string"))
        arr = F.when(F.coalesce(F.size(arr), F.lit(-1)) != F.col("expected_rows"), F.raise_error(msg)).otherwise(arr)
    return (pages.select("pull", "start_row", arr.alias("_recs"))
            .select("pull", "start_row", F.posexplode("_recs").alias("_i", "_r"))
            .select("pull", "start_row", (F.col("start_row") + F.col("_i")).alias("api_row"),
                    *[F.col(f"_r.{f}").alias(f) for f in spec.api_fields]))


def _reader(reader, options: dict):
    for k, v in options.items():
        if k != "strict":
            reader = reader.option(k, str(v))
    return reader.format("lmplake_feed")


def read_feed(spark, options: dict):
    """Batch read of a feed's pulls as decoded records."""
    register(spark)
    strict = str(options.get("strict", "true")).lower() != "false"
    return parse_feed_pages(_reader(spark.read, options).load(), options["feed"], strict)


def read_feed_stream(spark, options: dict):
    """Streaming read: new pulls as they appear, decoded."""
    register(spark)
    strict = str(options.get("strict", "true")).lower() != "false"
    return parse_feed_pages(_reader(spark.readStream, options).load(), options["feed"], strict)


def page_plan_frame(spark, options: dict):
    """The source's page plan as a DataFrame ``(pull, start_row, expected_rows)``: what
    ``partitions()`` would hand to executors (S2), from the headers only. Planned in
    Spark where the transport's headers are a table."""
    from pyspark.sql import functions as F

    from lmplake.operators.pulls import page_plan
    feed_name = options["feed"]
    t = load_transport(options)
    page_size = int(options.get("page_size", PAGE_SIZE))
    pulls = named_pulls(options)
    if hasattr(t, "headers_frame"):
        totals = t.headers_frame(spark, feed_name)
    else:
        totals = spark.createDataFrame(sorted(t.headers(feed_name).items()), "pull string, total_rows bigint")
    if pulls:
        totals = totals.join(spark.createDataFrame([(p,) for p in pulls], "pull string"), "pull", "left_semi")
    plan = page_plan(totals.select("pull", "total_rows", F.col("total_rows").alias("_t")), ["pull", "_t"], "total_rows", page_size)
    return plan.select("pull", "start_row", F.least(F.lit(page_size), F.col("_t") - F.col("start_row") + 1)
                       .cast("bigint").alias("expected_rows"))


def register(spark) -> None:
    """Register the source. Its modules are pickled by value, so the Python
    processes that plan batch reads and drive streaming offsets do not need
    ``lmplake`` installed; executors also get the package zip."""
    import sys

    from pyspark import cloudpickle

    import lmplake.feeds
    import lmplake.sources.paths
    from lmplake.session import ship_package
    for mod in (lmplake.feeds, lmplake.sources.paths, sys.modules[__name__]):
        cloudpickle.register_pickle_by_value(mod)
    ship_package(spark)
    spark.dataSource.register(FeedPagesDataSource)


def write_page_folder(pages, headers, root: str, feed_name: str, append: bool = False) -> None:
    """Land API-shaped pages (``pull, start_row, page_text``) and headers
    (``pull, total_rows``) in the layout ``PageFolderTransport`` serves.
    ``append`` adds pages next to the ones there. Headers go to the header log: only
    those that are new or differ from what the log says are added, as one landing."""
    from pyspark.sql import functions as F

    from lmplake.sources.paths import remove_dir
    (pages.select(F.lit(feed_name).alias("feed"), F.col("pull").cast("string"), "start_row", "page_text")
          .write.mode("append" if append else "overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("feed", "pull", "start_row").text(root))
    spark = pages.sparkSession
    t = PageFolderTransport({"root": root})
    log, last = f"{t.root}/_headers", t.log_end(feed_name)
    for landing in t._folders(log, "landing="):
        if landing > last:
            remove_dir(f"{log}/landing={landing}")  # a landing that died; its headers are given again
    new = headers.select(F.lit(feed_name).alias("feed"), F.col("pull").cast("string").alias("pull"),
                         F.col("total_rows").cast("bigint").alias("total_rows"))
    if last:
        known = t.headers_frame(spark, feed_name)
        new = new.join(known.withColumnRenamed("total_rows", "_known"), "pull", "left") \
            .where(~F.col("total_rows").eqNullSafe(F.col("_known"))).select("feed", "pull", "total_rows")
    folder = f"{log}/landing={int(last or 0) + 1:08d}"
    buckets = _write_buckets(new, f"{folder}/feed={feed_name}")
    _complete(folder, {"buckets": {feed_name: buckets}})
    if len(t.landings(t.snapshot(feed_name)[0])) >= SNAPSHOT_EVERY:
        compact_headers(spark, root, feed_name)


def _write_buckets(headers, folder: str) -> int:
    """Write entries (feed, pull, total_rows) cut into buckets; returns their number."""
    from pyspark.sql import functions as F
    headers = headers.cache()
    try:
        buckets = -(-headers.count() // BUCKET_ENTRIES)
        if buckets:
            headers.withColumn("bucket", F.pmod(F.crc32(F.encode("pull", "UTF-8")), F.lit(buckets)).cast("int")) \
                .repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "static") \
                .partitionBy("bucket").json(folder)
    finally:
        headers.unpersist()
    return buckets


def _complete(folder: str, mark: dict) -> None:
    fsys, p = fs_for(folder)
    fsys.create_dir(p, recursive=True)
    with fsys.open_output_stream(f"{p}/_writing") as out:
        out.write(json.dumps(mark).encode())
    fsys.move(f"{p}/_writing", f"{p}/_COMPLETE")


def compact_headers(spark, root: str, feed_name: str) -> str:
    """Write the latest header of each pull of a feed as a snapshot of the header log, up to its end (returned);
    snapshots older than the one before go. One that dies has no mark and is written again. Landings stay."""
    from pyspark.sql import functions as F

    from lmplake.sources.paths import exists, remove_dir
    t = PageFolderTransport({"root": root})
    end, (upto, _) = t.log_end(feed_name), t.snapshot(feed_name)
    if end == upto:
        return end
    base = f"{t.root}/_headers/_snapshots/{feed_name}"
    folder = f"{base}/upto={end}"
    latest = t.headers_frame(spark, feed_name).select(F.lit(feed_name).alias("feed"), "pull", "total_rows")
    _complete(folder, {"buckets": _write_buckets(latest, folder)})
    for old in t._folders(base, "upto="):
        if old < upto and exists(f"{base}/upto={old}"):
            remove_dir(f"{base}/upto={old}")
    return end
