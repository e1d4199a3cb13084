"""File readers with declared schemas, and payload flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STANDARD_CHARSETS = {"UTF-8", "UTF-16", "UTF-16BE", "UTF-16LE", "UTF-32", "ISO-8859-1", "US-ASCII"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header line. A byte-order mark is skipped; EUC-KR and others are read too.

    A charset outside Spark's short list needs ``spark.sql.legacy.javaCharsets``, which must hold
    when the file is read, so it stays set for the session.
    """
    if encoding.upper() not in STANDARD_CHARSETS:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    return spark.read.schema(schema).option("header", True).option("encoding", encoding).csv(path)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that each hold one JSON array of records; parallel across files."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_xml_items(spark: SparkSession, path: str, schema: T.StructType, row_tag: str = "item") -> DataFrame:
    """Landed XML pages, one row per ``row_tag``.

    Tags are read as text, then cast: an empty element or text that is no number gives null.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    rows = spark.read.format("xml").option("rowTag", row_tag).schema(text).load(path)
    return rows.select(*[
        F.col(f.name) if isinstance(f.dataType, T.StringType)
        else F.nullif(F.trim(f.name), F.lit("")).try_cast(f.dataType).alias(f.name)
        for f in schema
    ])


def envelope_rows(df: DataFrame, payload, schema: str, path: str, *keys: str) -> DataFrame:
    """Rows at ``path`` inside a JSON payload; a payload without that path gives none."""
    parsed = df.select(*keys, F.from_json(payload, schema).alias("parsed"))
    return parsed.select(*keys, F.inline(F.col(f"parsed.{path}")))


def flatten_trend(df: DataFrame, results: str = "results") -> DataFrame:
    """``results[{title, data[{period, ratio}]}]`` to one row per group and period."""
    groups = df.select(F.explode(results).alias("r"))
    return groups.select(F.col("r.title").alias("group_name"), F.inline("r.data"))


def enforce_schema(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Exactly the declared columns and types, in order.

    A missing column is an error. ``strict`` raises on a value that does not cast, otherwise it
    becomes null; a null in a non-nullable column raises while the rows are read.
    """
    present = {name.lower() for name in df.columns}
    missing = [f.name for f in schema if f.name.lower() not in present]
    if missing:
        raise ValueError(f"missing columns: {missing}")

    def cast(field: T.StructField) -> Column:
        source = F.col(f"`{field.name}`")
        value = source.cast(field.dataType) if strict else source.try_cast(field.dataType)
        if not field.nullable:
            value = F.when(value.isNull(), F.raise_error(F.lit(f"null in {field.name}"))).otherwise(value)
        return value.alias(field.name)

    return df.select(*[cast(field) for field in schema])
