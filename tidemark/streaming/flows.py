"""Structured Streaming forms of the scheduled loads. Each run takes what has landed and stops."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import append_new_rows

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def landed_files(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet",
                 files_per_batch: int | None = None) -> DataFrame:
    """Stream over the files of a folder or glob, with a declared schema."""
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def on_event_time(df: DataFrame, stamp: str) -> DataFrame:
    """The stamp as ``timestamp``, which watermarks need; stored zone-less stamps load as ``timestamp_ntz``."""
    return df.withColumn(stamp, F.col(stamp).cast("timestamp"))


def run(df: DataFrame, target: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything landed since the last run into parquet, exactly once, then stop."""
    query = (
        df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(target)
    )
    query.awaitTermination()


def unseen_keys(df: DataFrame, keys: Iterable[str], stamp: str, delay: str) -> DataFrame:
    """First row per key; a key is remembered until the watermark has passed it by ``delay``, and rows later than that are dropped.

    Use :func:`run_new_rows` where no key may be lost.
    """
    return on_event_time(df, stamp).withWatermark(stamp, delay).dropDuplicatesWithinWatermark(list(keys))


def run_new_rows(df: DataFrame, target: str, checkpoint: str, keys: Iterable[str]) -> None:
    """Append rows with keys the target lacks, with no time limit on what counts as seen.

    The anti join makes a repeated batch add nothing, so a retry after a lost executor is safe.
    A key repeated inside one batch is kept once.
    """
    keys = list(keys)

    def write(batch: DataFrame, _batch_id: int) -> None:
        append_new_rows(batch.sparkSession, batch.dropDuplicates(keys), target, keys)

    query = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def first_of_keys(df: DataFrame, keys: Iterable[str], stored: DataFrame | None = None) -> DataFrame:
    """The first row of each key of a stream, in update mode: ``known`` (1 for a ``stored`` key), ``first`` and ``last``, the times of the
    batches that had the key, and the row. A key is new in a batch that is its first and its last.

    ``stored`` is a stream of keys, taken whole in the first batch; a batch's rows meet in one state of the key, so their order does
    not matter. State is keyed by the key and never expires, on the executors' disks. Null is a key.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest) if rest else F.lit(None).cast("int")
    both = df.select(*keys, row.alias("row"), F.lit(0).alias("known"))
    if stored is not None:
        both = both.unionByName(stored.select(*keys, F.lit(None).cast(both.schema["row"].dataType).alias("row"), F.lit(1).alias("known")))
    both, now = both.withColumn("now", F.current_timestamp()), F.col("now")
    held = [F.first("row").alias("row")] if rest else []
    return both.groupBy(*keys).agg(F.max("known").alias("known"), F.min(now).alias("first"), F.max(now).alias("last"), *held)


def run_first_of_keys(df: DataFrame, target: str, checkpoint: str, keys: Iterable[str], stored: DataFrame | None = None) -> None:
    """Append the first row of each key of a stream that was never seen before, however late it comes, and no row of a ``stored`` key,
    to parquet, each row once, and stop when all that has landed is taken.

    The keys of ``stored`` enter the state when the stream first starts and the table is not read again, neither by later batches nor
    after a restart. A batch's new rows go to a folder of their own beside ``checkpoint``, which a retry writes again; a second stream
    takes such folders to ``target``. Such state needs the RocksDB store, which the stream gets whatever the session's own setting is.
    """
    spark, keys = df.sparkSession, list(keys)
    seeds, found = f"{checkpoint}-stored", f"{checkpoint}-found"
    known = None
    if stored is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{seeds}/_SUCCESS")
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            stored.select(*keys).distinct().write.mode("overwrite").parquet(seeds)
        known = landed_files(spark, seeds, stored.select(*keys).schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        new = batch.where((F.col("first") == F.col("last")) & (F.col("known") == 0))
        columns = [F.col(c) if c in keys else F.col("row")[c].alias(c) for c in df.columns]
        new.select(*columns).write.mode("overwrite").parquet(f"{found}/batch-{batch_id}")

    conf, before = spark.conf, spark.conf.get(STORE, None)
    conf.set(STORE, ROCKS_DB)
    try:
        query = (first_of_keys(df, keys, known).writeStream.foreachBatch(write).outputMode("update")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        conf.unset(STORE) if before is None else conf.set(STORE, before)
    run(landed_files(spark, f"{found}/batch-*", df.schema), target, f"{checkpoint}-taken")


def buckets(df: DataFrame, keys: Iterable[str], stamp: str, value: str, unit: str) -> DataFrame:
    """Count and mean per key and date, week (from Monday) or month; batch and stream alike."""
    if unit == "month":
        start = F.date_trunc("month", stamp).alias("bucket")
    elif unit == "week":
        start = F.window(stamp, "1 week", startTime="4 days")["start"].alias("bucket")
    else:
        start = F.window(stamp, "1 day")["start"].alias("bucket")
    return df.groupBy(*keys, start).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"))


#: Days that each month takes on the even month clock: more than any month has, a change of the clocks included.
MONTH_DAYS = 32
_MONTH = MONTH_DAYS * 86_400_000_000


def month_clock(stamp: str) -> Column:
    """The stamp on a clock whose months all take ``MONTH_DAYS`` days: month by month the same order and, inside a month, the same time."""
    start = F.date_trunc("month", stamp)
    months = (F.year(stamp) - 1970) * 12 + F.month(stamp) - 1
    return F.timestamp_micros(months.cast("long") * F.lit(_MONTH) + F.unix_micros(F.col(stamp)) - F.unix_micros(start))


def month_of_clock(start: Column) -> Column:
    """The first moment of the calendar month that begins at ``start`` of the month clock."""
    months = F.floor(F.unix_micros(start) / F.lit(_MONTH)).cast("int")
    return F.make_date(F.floor(months / 12).cast("int") + 1970, F.pmod(months, F.lit(12)) + 1, F.lit(1)).cast("timestamp")


def bucket_stream(df: DataFrame, keys: Iterable[str], stamp: str, value: str, unit: str, delay: str) -> DataFrame:
    """Date, week or month buckets of a stream; a bucket is emitted once the watermark has passed it, later rows for it are dropped.

    Calendar months have no fixed length, which windows and watermarks need, so months are cut on :func:`month_clock`. There a month ends where
    the next begins, so a month is emitted ``delay`` after the next one has begun. Of a longer delay than a month, each month
    takes 32 days. Rows with a null stamp are in no bucket.
    """
    if unit not in ("date", "week", "month"):
        raise ValueError("a stream has date, week and month buckets")
    timed, length, first = on_event_time(df, stamp), {"date": "1 day", "week": "1 week", "month": f"{MONTH_DAYS} days"}[unit], F.col("w.start")
    if unit == "month":
        timed, first = timed.withColumn(stamp, month_clock(stamp)), month_of_clock(first)
    window = F.window(stamp, length, startTime="4 days") if unit == "week" else F.window(stamp, length)
    grouped = timed.withWatermark(stamp, delay).groupBy(*keys, window.alias("w")).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"))
    return grouped.select(*keys, first.alias("bucket"), "n", "mean")
