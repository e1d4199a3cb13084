"""Access to the input tables and the named-query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """``Tables(spark, folder).orders`` reads ``folder/orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def wide(self, name: str) -> DataFrame:
        """The table for work that is heavy per row.

        Stored in fewer splits than there are cores it is spread over them first; a table of many
        files, as any large one is, comes back as it is stored, without a shuffle.
        """
        df = getattr(self, name)
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def register_views(self, *names: str) -> None:
        """Temp views for SQL text; column names with spaces or Hangul need back-quotes there."""
        for name in names or TABLE_NAMES:
            getattr(self, name).createOrReplaceTempView(name)


class NamedQueries:
    """Query id to DataFrame function, with messages for an unknown id and an empty result."""

    UNKNOWN = "unknown query id: {}"
    EMPTY = "no rows for query id: {}"

    def __init__(self):
        self.functions: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, oracle: str | None = None):
        """Register a function of :class:`Tables`; ``oracle`` is SQL with the same result."""

        def register(function):
            if name in self.functions:
                raise ValueError(f"duplicate query {name}")

            def call(spark: SparkSession, folder: str) -> DataFrame:
                return function(Tables(spark, folder))

            call.__doc__ = function.__doc__
            self.functions[name] = call
            if oracle is not None:
                self.oracles[name] = oracle
            return function

        return register

    def run(self, spark: SparkSession, folder: str, name: str) -> tuple[DataFrame | None, str]:
        """The result and an empty message, or a message that says why there is none."""
        function = self.functions.get(name)
        if function is None:
            return None, self.UNKNOWN.format(name)
        result = function(spark, folder)
        if result.isEmpty():
            return result, self.EMPTY.format(name)
        return result, ""


def execute_query(spark: SparkSession, sql: str) -> DataFrame | None:
    """SQL text to a DataFrame; text that does not parse or resolve gives ``None``."""
    from pyspark.errors import AnalysisException, ParseException

    try:
        return spark.sql(sql)
    except (AnalysisException, ParseException):
        return None


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
              partitions: int, properties: dict[str, str] | None = None) -> DataFrame:
    """Partitioned JDBC scan; filters and column selection are pushed to the database."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return (
        reader.option("partitionColumn", partition_column).option("lowerBound", lower)
        .option("upperBound", upper).option("numPartitions", partitions).load()
    )
