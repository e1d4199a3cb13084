"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build(app_name: str = "tidemark", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators expect; nothing here depends on data size.

    Joins carry no broadcast hints anywhere in this package: the planner and AQE broadcast a
    side only when its measured size is under ``autoBroadcastJoinThreshold`` and otherwise
    sort-merge with skew splitting.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.legacy.javaCharsets", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one machine, may fall back to a temporary
    folder; a cluster without the setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path under the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame, **options: str) -> DataFrame:
    """``df`` written to the shared folder, with the writer's ``options``, and read back.

    Used where a value depends on physical placement, where several jobs read one costly result,
    and where a later join should know the measured size of a small side: the planner sees the
    file size and broadcasts or not by its threshold. Lineage ends here, so a lost executor costs
    no recomputation.
    """
    path = run_folder(df.sparkSession, "pinned")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unpin(df: DataFrame) -> None:
    """Delete the pinned tables that ``df`` reads, once nothing else reads them any more."""
    jvm, hadoop = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings that hold inside the block."""
    before = {key: spark.conf.get(key) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
