"""Helpers shared by the operators of this package."""

from __future__ import annotations

from contextlib import contextmanager
from threading import get_ident

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import run_folder

#: Deletes the ASCII white space that the text contracts name.
WHITE = " \t\n\x0b\x0c\r"


#: By thread, the folders that its :func:`scratch` blocks answer for, the innermost block last. Plain, as it goes with worker code.
MADE: dict[int, list[list[str]]] = {}


def folder(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, deleted with the :func:`scratch` it is made in."""
    path = run_folder(spark, label)
    for made in MADE.get(get_ident(), [])[-1:]:
        made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession):
    """A list for the tables that are still read after the block; all other tables pinned inside it are deleted at its end.

    Tables that the listed ones read are kept, and left to the block around this one, if any. After an error nothing is deleted.
    """
    made, kept, blocks = [], [], MADE.setdefault(get_ident(), [])
    blocks.append(made)
    try:
        yield kept
    finally:
        blocks.pop()
        if not blocks:
            del MADE[get_ident()]
    read = {name.rpartition("/")[0].rpartition("/")[2] for df in kept for name in df.inputFiles()}
    jvm, hadoop = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in made:
        if name.rpartition("/")[2] not in read:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(hadoop).delete(path, True)
        elif blocks:
            blocks[-1].append(name)


def pin(df: DataFrame, label: str = "llm") -> DataFrame:
    """``df`` as Parquet in the shared folder, read back: lineage ends, sizes are measured, retries see one result."""
    path = folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_file_backed(df: DataFrame) -> bool:
    """Whether rows carry the file and row number they were read from."""
    from pyspark.errors import AnalysisException

    try:
        df.select(*(df.metadataColumn("_metadata")[name] for name in ("file_path", "row_index"))).schema
        return True
    except AnalysisException:
        return False


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(name: str = "text"):
    """The UTF-8 bytes of a text column; null is empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a row number of its own as string ``name``: file and position, stable over retries.

    Rows that come from no file are pinned first.
    """
    if not is_file_backed(df):
        df = pin(df, "rows")
    origin = df.metadataColumn("_metadata")
    place = F.concat_ws(":", F.hex(F.xxhash64(origin["file_path"])), origin["row_index"].cast("string"))
    return df.select("*", place.alias(name))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns: ``names``, with underscores before them until no column of ``df`` is called so in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def slices(batch, rows: int = 256):
    """A record batch in pieces, so what a task makes of them stays small however long texts are."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def release() -> None:
    """Give memory that Arrow's pool and the C library hold unused back to the system."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not the GNU library
        pass


def lean(run):
    """``run``, a function for mapInArrow, with :func:`release` at a task's end: workers wait for their next task with what the last one held at its peak."""
    def task(batches):
        yield from run(batches)
        release()

    return task


def by_bytes(batch, name: str, size: int = 8 << 20):
    """A record batch in pieces whose texts or bytes in column ``name`` make about ``size`` bytes, a longer row a piece of its own."""
    import numpy as np
    import pyarrow.compute as pc

    length = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    bucket = np.cumsum(length, dtype="int64") // size
    edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), batch.num_rows]
    for low, high in zip(edges, edges[1:]):
        yield batch.slice(low, high - low)


def unpin(df: DataFrame) -> None:
    """Delete the files of a pinned table that nothing reads any more."""
    jvm, hadoop = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)


def numbered(df: DataFrame, keys: list[str], order: list[str], position: str, total: str, label: str) -> DataFrame:
    """``df`` with each row's 0-based ``position`` among the rows of equal ``keys`` (null is a key), and their ``total``; written once.

    A range partitioning on keys and order cuts a key of any size into many partitions; the counts of (partition, key) say what comes
    before each. ``order`` must tell rows apart, or leave apart only rows that can stand for each other.
    """
    part, at, first, rows = "\0part", "\0at", "\0first", "\0rows"
    placed = pin(df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
                 .withColumn(part, F.spark_partition_id()).withColumn(at, F.monotonically_increasing_id()), label)
    counts = placed.groupBy(part, *keys).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(rows))
    every = Window.partitionBy(*keys)
    before = every.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        F.col(part).alias(part + "2"), *(F.col(k).alias(f"\0{k}") for k in keys),
        (F.coalesce(F.sum(rows).over(before), F.lit(0)) - F.col(first)).alias("\0shift"), F.sum(rows).over(every).alias(total))
    match = F.col(part) == F.col(part + "2")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"\0{k}"))
    return placed.join(pin(shifts, label), match).select(*df.columns, (F.col(at) + F.col("\0shift")).alias(position), total)


def settle(spark: SparkSession) -> None:
    """Collect the driver's garbage, which lets Spark's cleaner delete the shuffle files of finished steps.

    Executors keep a shuffle's files as long as the driver has not collected the plan that made it; between large steps of one operator
    that would add up.
    """
    spark.sparkContext._jvm.System.gc()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings that hold inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: Lets the planner put a Bloom filter of the wanted keys, of at most 8 MB, under the scan of the texts.
RUNTIME_FILTER = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
}


def fetch(texts: DataFrame, wanted: DataFrame, key: str, label: str) -> DataFrame:
    """``texts`` joined with the ``wanted`` rows (stored, few of all) on ``key``, pinned.

    Texts are wide and few are wanted, so most are filtered out before the shuffle. The filter only spares work: the join decides.
    """
    with settings(texts.sparkSession, RUNTIME_FILTER):
        # The planner builds the filter from a side that has a predicate.
        return pin(texts.join(wanted.where(F.length(key) > 0), key), label)
