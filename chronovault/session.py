"""Session settings the package relies on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SQL_SETTINGS = {
    # system_date is stored and compared in UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs a further shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # top-k per key keeps its cut below the shuffle up to this k
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    # call-site capture on every column operation costs more than building the plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


_PARTITION_BYTES = 256 * 1024**2


def cluster_settings(shuffle_bytes: int) -> dict[str, str]:
    """Settings for a cluster run whose largest shuffle is about ``shuffle_bytes``.

    Enough shuffle partitions that one fits an executor's memory share; AQE merges the
    small ones. Streaming state lives on disk.
    """
    partitions = min(100_000, max(200, shuffle_bytes // _PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(_PARTITION_BYTES),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def build_session(app_name: str = "chronovault", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; extra settings as ``spark__sql__x="y"`` or a dict."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's shared folder (``spark.checkpoint.dir``).

    A session on one machine that names no folder gets one, once; any other is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="chronovault-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, for use by several actions.

    Unlike a cache it survives the loss of executors, and every reader sees the same rows.
    """
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_bucketed(spark: SparkSession, df: DataFrame, name: str, key: str) -> DataFrame:
    """As ``materialise``, with the rows hashed by ``key`` into as many buckets as a shuffle has partitions: a later grouping by the
    key takes the files as they are. The catalog knows the table only until its layout is read; the files stay.
    """
    path = scratch_path(spark, name)
    table = "scratch_" + uuid.uuid4().hex
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", path).format("parquet").saveAsTable(table)
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")
