"""Table and document sinks. All writers run in parallel on the executors."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _partitioned(writer, by: Iterable[str]):
    by = list(by)
    return writer.partitionBy(*by) if by else writer


def append(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    _partitioned(df.write.mode("append"), partition_by).parquet(path)


def replace(df: DataFrame, path: str, partition_by: Iterable[str] = (), only_touched: bool = False) -> None:
    """Overwrite a table, or with ``only_touched`` just the partitions present in ``df``."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if only_touched else "static")
    _partitioned(writer, partition_by).parquet(path)


def documents(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON document per row; arrays, structs and maps stay nested."""
    df.write.mode(mode).json(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def csv_export(df: DataFrame, path: str, columns: Iterable[str], encoding: str = "UTF-8") -> None:
    """Selected columns as CSV with a header line."""
    if encoding.upper() not in ("UTF-8", "ISO-8859-1", "US-ASCII"):
        df.sparkSession.conf.set("spark.sql.legacy.javaCharsets", "true")
    df.select(*columns).write.mode("overwrite").option("header", True).option("encoding", encoding).csv(path)


def json_records(df: DataFrame, *columns: str) -> Column:
    """One JSON object per row, timestamps in ISO form."""
    fields = [F.col(c) for c in (columns or df.columns)]
    return F.to_json(F.struct(*fields), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss", "ignoreNullFields": "false"})


def nested_to_json(df: DataFrame) -> DataFrame:
    """Array, map and struct columns as JSON text, the others unchanged; chosen from the schema."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[
        F.to_json(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def bulk_load(spark: SparkSession, source: str, target: str, columns: Iterable[str], file_format: str = "parquet",
              truncate: bool = False) -> None:
    """Files to a table: listed columns only, appended, or replacing the rows with ``truncate``."""
    rows = spark.read.format(file_format).load(source).select(*columns)
    rows.write.mode("overwrite" if truncate else "append").parquet(target)


def drop_sensitive(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Without the named columns, whatever their case; an unknown name is an error."""
    actual = {c.lower(): c for c in df.columns}
    unknown = [n for n in names if n.lower() not in actual]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    return df.drop(*[actual[n.lower()] for n in names])
