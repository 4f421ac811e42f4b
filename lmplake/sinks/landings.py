"""Landing numbers that never repeat, whatever restarts (K1).

A landing's number is the upper half of the merge order, so it has to grow with every landing of a lake:
a number that comes again replaces an older landing, one that starts anew loses against older rows. Batch ids
do both when a stream gets a new checkpoint. Here a number is claimed in the lake itself:

* ``<folder>/numbers/<n>`` is created exclusively (a second writer's create fails and it tries n + 1). Only the highest
  numbers are kept; a writer that finds a higher one after its own create gives its number up, so one that was
  cleared away can't be had twice.
* ``<folder>/owners/<name>`` remembers the number of a unit of work (a batch of one query, by its checkpoint's own id),
  so a batch that is run again after a failure lands under the number of its first attempt.

Numbers may have gaps (an attempt that fails between the two steps), never repeats.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lmplake.feeds import FeedSpec
from lmplake.sinks.lake import MAX_LANDING, land_intake, stamp_ingest_seq

KEPT = 32


class Files:
    """The folder's file system, as Spark has it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm, self.folder = spark.sparkContext._jvm, folder.rstrip("/")
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def create(self, name: str, text: str) -> bool:
        """Create the file, if it isn't there; whether this call did."""
        from py4j.protocol import Py4JJavaError
        at = self.path(name)
        try:
            out = self.fs.create(at, False)
        except Py4JJavaError as e:
            if self.fs.exists(at):
                return False
            raise e
        out.write(text.encode())
        out.close()
        return True

    def read(self, name: str) -> str | None:
        at = self.path(name)
        if not self.fs.exists(at):
            return None
        stream = self.fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def names(self, sub: str) -> list[str]:
        at = self.path(sub)
        if not self.fs.exists(at):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(at)]

    def move(self, name: str, to: str) -> bool:
        """Give a file another name that is free; whether it was. (``FileContext`` fails on a taken name everywhere,
        where a plain rename replaces it on some file systems.)"""
        from py4j.protocol import Py4JJavaError
        fc = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path("").toUri(), self.conf)
        none = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            fc.rename(self.fs.makeQualified(self.path(name)), self.fs.makeQualified(self.path(to)), none)
        except Py4JJavaError as e:
            if self.fs.exists(self.path(to)):
                return False
            raise e
        return True

    def delete(self, name: str, whole: bool = False) -> None:
        self.fs.delete(self.path(name), whole)


def claim_landing(spark: SparkSession, folder: str, owner: str) -> int:
    """The landing number of ``owner`` (a name for one unit of work), claimed on the first call."""
    files = Files(spark, folder)
    name = f"owners/{hashlib.sha256(owner.encode()).hexdigest()}"
    known = files.read(name)
    if known:
        return int(known)
    highest = max((int(n) for n in files.names("numbers") if n.isdigit()), default=0)
    while True:
        highest += 1
        if highest > MAX_LANDING:
            raise ValueError(f"landing numbers are used up ({MAX_LANDING})")
        if not files.create(f"numbers/{highest}", owner):
            continue
        taken = [int(n) for n in files.names("numbers") if n.isdigit()]
        if max(taken) == highest:
            break
        highest = max(taken)
    for n in sorted(taken)[:-KEPT]:
        files.delete(f"numbers/{n}")
    if files.create(name, str(highest)):
        return highest
    return int(files.read(name))  # the same work, claimed by another attempt at the same time


def query_name(spark: SparkSession, checkpoint: str) -> str:
    """The id that Structured Streaming gave a checkpoint: a new checkpoint in the same place has another."""
    text = Files(spark, checkpoint).read("metadata")
    if text is None:
        raise FileNotFoundError(f"no streaming query has started at {checkpoint}")
    return json.loads(text)["id"]


def start_landing(rows: DataFrame, intake_dir: str, landings_dir: str, checkpoint: str, spec: FeedSpec,
                  row_col: str = "api_row", available_now: bool = True, processing_time: str = "1 minute"):
    """Land a stream of typed rows: each micro-batch is one landing, numbered in the lake (``landings_dir`` is shared by all
    streams that land there), stamped with the merge order and written to its own folders. Any number of
    streams and checkpoints may land in one intake, one after the other or together."""
    spark = rows.sparkSession

    def land(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        number = claim_landing(spark, landings_dir, f"{query_name(spark, checkpoint)}/{batch_id}")
        land_intake(stamp_ingest_seq(batch, F.lit(number), row_col), intake_dir, spec, number)

    w = rows.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
