"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "pitchcast", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with AQE on, UTC time zone and no UI (local runs and tests).

    Master, memory and shuffle partitions stay as spark-submit has them unless
    they are passed. On a cluster, pass the master through spark-submit and size
    ``spark.sql.shuffle.partitions`` to the data (AQE coalesces small ones).
    """
    b = (SparkSession.builder.appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true"))
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``; a scratch folder only when unset (tests)."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                           "(a machine-local scratch folder is only used in local mode)")
    path = tempfile.mkdtemp(prefix="pitchcast-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df, name: str):
    """Write ``df`` once as parquet under ``spark.checkpoint.dir`` and read it back.

    A lineage cut that survives executor loss (the files are on the shared
    folder), stays columnar (later scans prune columns and push filters), and
    computes its input exactly once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)   # known schema: no footer inference


def scratch_path(spark, name: str) -> str:
    """A new folder's path under ``spark.checkpoint.dir``, which ``release_materialized`` deletes."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def scratch_inputs(df) -> list[str]:
    """The ``materialize`` folders that ``df`` reads (from its input-file metadata)."""
    files = df.inputFiles()
    return [p for p in _SCRATCH if any(p in f for f in files)]


def release_materialized(spark, paths=None) -> int:
    """Delete ``materialize`` folders (default: all written by this process).

    Call once nothing reads them any more (after the job's output is written),
    so the shared checkpoint folder does not grow run after run.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    targets = list(_SCRATCH) if paths is None else [p for p in paths if p in _SCRATCH]
    done = 0
    for p in targets:
        _SCRATCH.remove(p)
        path = jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(conf).delete(path, True):
            done += 1
    return done
