"""Session construction and the shared scratch folder.

On a cluster the scratch folder must be the shared one named by
``spark.checkpoint.dir``; a folder of our own is only created when that setting
is absent (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces/splits
# shuffle partitions from runtime sizes; skew-join splits hot partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# For streaming jobs with large join / aggregation state (production-size
# deadline joins): keep the state in RocksDB, off the JVM heap.  Pass as
# ``build_session(extra=LARGE_STATE_CONF)``; small local runs are faster
# with the default provider.
LARGE_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 << 20, minimum: int = 200) -> int:
    """Initial shuffle partition count for an input volume: about one
    partition per ``target_bytes`` (e.g. 100 TB -> ~400k).  AQE coalesces the
    small ones at run time but cannot split a partition that is too big, so
    the initial count must be sized for the largest shuffle."""
    return max(minimum, -(-int(input_bytes) // target_bytes))


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera", extra: dict | None = None,
                  input_bytes: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library relies on.

    ``input_bytes`` sizes ``spark.sql.shuffle.partitions`` for the data volume
    (see ``shuffle_partitions_for``) when no explicit count is given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if not shuffle_partitions and input_bytes:
        shuffle_partitions = shuffle_partitions_for(input_bytes)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Return a fresh sub-folder of the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir); only when
    neither is set (tests, local runs) a private folder is created and
    registered as the checkpoint dir.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        base = _own_folder(spark)
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    sub = "/".join([*(p.strip("/") for p in parts), uuid.uuid4().hex[:12]])
    return base.rstrip("/") + "/" + sub if sub else base


def _own_folder(spark: SparkSession) -> str:
    """A private folder, which only a local session may use: on a cluster the
    executors would not see it."""
    if not (spark.sparkContext.master + "[").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="tessera-ckpt-")


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side access to a local path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return os.fspath(path)


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified Hadoop form of a path (e.g. ``file:/tmp/x``)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString()


def pyarrow_filesystem(path: str):
    """(pyarrow filesystem, path) for a Hadoop-style URI, for Python code in
    tasks that reads or writes single objects.  Hadoop's S3 connector names
    (s3a, s3n) map to pyarrow's s3."""
    from pyarrow import fs as pafs
    for hadoop_scheme in ("s3a://", "s3n://"):
        if path.startswith(hadoop_scheme):
            path = "s3://" + path[len(hadoop_scheme):]
    return pafs.FileSystem.from_uri(path)
