"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of ours wants. On a cluster the launcher supplies
# master, memory and spark.checkpoint.dir; we only fill what is unset.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with our defaults.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them unset and let spark-submit decide.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable folder for ``DataFrame.checkpoint`` and written tables.

    Read from ``spark.checkpoint.dir``; only when the session has none (local
    runs, tests) do we make a scratch folder and register it.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not (sc.master or "").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(d)
    return d


_WRITTEN: list[str] = []   # tables this process wrote with materialize()


def drop_materialized(spark: SparkSession) -> int:
    """Delete the tables :func:`materialize` wrote in this process (through
    the Hadoop FileSystem of the path, so HDFS and object stores work as
    the local disk does). Call it when a pipeline's results are written:
    DataFrames read from those tables are invalid afterwards. Returns the
    number of tables removed."""
    done = 0
    while _WRITTEN:
        if delete_folder(spark, _WRITTEN.pop()):
            done += 1
    return done


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder that this process wrote; whether there was one."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df, name: str = "table"):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back: later passes (fit jobs, then the apply) scan a flat,
    columnar table with pruning and pushdown instead of recomputing the
    joins behind it, and a lost executor re-reads files instead of
    replaying lineage."""
    import uuid
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.append(path)
    return spark.read.parquet(path)
