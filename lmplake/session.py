"""Session defaults for the lake jobs and the shared folder they write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# Sizing for a large cluster (hundreds of TB of day tables). Partitions are
# sized by bytes, not counts: scans split at 256 MB, AQE coalesces shuffle
# output toward 256 MB and splits skewed partitions above it; the initial
# shuffle partition count is high so a full-table merge never starts with
# partitions that spill, and AQE shrinks it for small batches.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "lmplake", cluster: bool = False) -> SparkSession:
    """Session with the lake's defaults. ``cluster=True`` adds ``CLUSTER_CONF``."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # sweeps, fetch cycles and group stats checkpoint small frames; remove the
        # files once unreferenced, or a long-running stream fills the shared folder
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    return s


_LOCAL_DIRS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. A cluster has to set it;
    only in local mode (tests) a private folder is made when it is unset."""
    sc = spark.sparkContext
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if not conf_dir and not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        if not conf_dir and sc.applicationId not in _LOCAL_DIRS:
            _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="lmplake-ckpt-")
        sc.setCheckpointDir(conf_dir or _LOCAL_DIRS[sc.applicationId])
    if conf_dir:
        return conf_dir
    if sc.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[sc.applicationId] = os.path.dirname(sc.getCheckpointDir().rstrip("/"))
    return _LOCAL_DIRS[sc.applicationId]


def reliable_checkpoint(df):
    """``df.checkpoint(eager=True)`` into the shared checkpoint folder, which
    is made sure to exist first (never ``localCheckpoint``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def lake_root(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder for lake tables under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/lmplake/{name or uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Make ``lmplake`` importable in Python workers (needed by the Python
    Data Source). The zip goes to the shared checkpoint folder and is added
    once per SparkContext with ``addPyFile``."""
    import hashlib
    import io
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_lmplake_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    data = buf.getvalue()
    base = ensure_checkpoint_dir(spark)
    target = f"{base.rstrip('/')}/lmplake-pkg/lmplake-{hashlib.sha1(data).hexdigest()[:12]}.zip"
    from pyarrow import fs as pafs
    fsys, path = pafs.FileSystem.from_uri(target if "://" in target else os.path.abspath(target.replace("file:", "", 1)))
    fsys.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with fsys.open_output_stream(path) as out:
        out.write(data)
    sc.addPyFile(target)
    sc._lmplake_shipped = True
