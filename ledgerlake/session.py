"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ledgerlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.ui.enabled", "false")
        # Plans here have hundreds of columns; recording the call site of each one is slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(input_bytes: int, task_bytes: int = 256 << 20, least: int = 200, most: int = 100_000) -> int:
    """Partitions a shuffle of ``input_bytes`` should start with so that each fits a task.

    Give it to ``spark.sql.shuffle.partitions`` for the job: adaptive execution merges small
    partitions afterwards but never splits one that an explicit layout by key made too large.
    """
    return max(least, min(most, -(-input_bytes // task_bytes)))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by key over all shuffle partitions.

    Adaptive execution merges the partitions of an exchange by their compressed size. Ids and repeated texts compress
    many times, so that a task that groups, sorts or hashes them would hold several GB; given in numbers they stay apart.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def work_dir(spark: SparkSession) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The cluster names that directory in ``spark.checkpoint.dir``. A local temporary folder is
    used only where the setting is absent *and* the master is local (tests).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="ledgerlake-")
    return f"{root.rstrip('/')}/ledgerlake-{uuid.uuid4().hex[:12]}"
