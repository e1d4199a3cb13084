"""Stream forms and time buckets."""

from pyspark.sql import functions as F

from tidemark.plans import query
from tidemark.session import run_folder
from tidemark.streaming import flows


@query("stream_append", oracle="SELECT event_id, event_type, round(value, 4) AS value FROM events")
def stream_append(t):
    landed = flows.landed_files(t.spark, t.path("events") + "*", t.events.schema)
    target = run_folder(t.spark, "landed")
    flows.run(landed.select("event_id", "event_type", F.round("value", 4).alias("value")), target, target + "-progress")
    return t.spark.read.parquet(target)


@query("stream_dedup", oracle="SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(t):
    """Keys never seen before, however late or often they come: no key is forgotten and none is lost."""
    landed = flows.landed_files(t.spark, t.path("events") + "*", t.events.schema)
    target = run_folder(t.spark, "unseen")
    flows.run_new_rows(landed.select("user_id", "event_type"), target, target + "-progress", ["user_id", "event_type"])
    return t.spark.read.parquet(target)


@query("stream_unseen", oracle="SELECT DISTINCT user_id, event_type FROM events WHERE user_id IS NOT NULL EXCEPT SELECT user_id, event_type FROM events WHERE event_id % 7 = 0")
def stream_unseen(t):
    """Keys that a stored table and the stream so far lack, from state alone; the stream is taken up twice."""
    stored = t.events.where("event_id % 7 = 0").select("user_id", "event_type")
    landed = flows.landed_files(t.spark, t.path("events") + "*", t.events.schema).where("user_id IS NOT NULL").select("user_id", "event_type")
    target = run_folder(t.spark, "unseen")
    for _ in range(2):
        flows.run_first_of_keys(landed, target, target + "-progress", ["user_id", "event_type"], stored)
    return t.spark.read.parquet(target)


def _bucket_sql(unit):
    return f"""SELECT event_type, strftime(date_trunc('{unit}', ts), '%Y-%m-%d') AS bucket, count(*) AS n, round(avg(value), 8) AS mean
FROM events GROUP BY ALL"""


def _buckets(t, unit):
    rows = flows.buckets(t.events, ["event_type"], "ts", "value", unit)
    return rows.select("event_type", F.date_format("bucket", "yyyy-MM-dd").alias("bucket"), "n", F.round("mean", 8).alias("mean"))


@query("bucket_day", oracle=_bucket_sql("day"))
def bucket_day(t):
    return _buckets(t, "date")


@query("bucket_week", oracle=_bucket_sql("week"))
def bucket_week(t):
    return _buckets(t, "week")


@query("bucket_month", oracle=_bucket_sql("month"))
def bucket_month(t):
    return _buckets(t, "month")


def _closed_sql(table, key, stamp, value, unit):
    start = f"date_trunc('{unit}', CAST({stamp} AS TIMESTAMP))"
    return f"""SELECT {key}, strftime({start}, '%Y-%m-%d') AS bucket, count(*) AS n, round(avg({value}), 4) AS mean
FROM {table} GROUP BY {key}, {start}
HAVING {start} + INTERVAL 1 {unit} <= (SELECT max(CAST({stamp} AS TIMESTAMP)) FROM {table}) - INTERVAL 1 DAY"""


def _closed(t, table, key, stamp, value, unit):
    """Buckets that a stream over the landed rows has closed: those that end a day or more before the newest row."""
    landed = flows.landed_files(t.spark, t.path(table) + "*", getattr(t, table).schema).select(key, stamp, value)
    target = run_folder(t.spark, f"buckets-{unit}")
    flows.run(flows.bucket_stream(landed, [key], stamp, value, unit, "1 day"), target, target + "-progress")
    rows = t.spark.read.schema(f"{key} string, bucket timestamp, n long, mean double").parquet(target)
    # Scaled, rounded and scaled back, as the SQL twin rounds: a mean such as 38.37875 lies below its tie.
    return rows.select(key, F.date_format("bucket", "yyyy-MM-dd").alias("bucket"), "n", (F.round(F.col("mean") * 10_000) / 10_000).alias("mean"))


_EVENTS, _ORDERS = ("events", "event_type", "ts", "value"), ("orders", "o_orderpriority", "o_orderdate", "o_totalprice")


@query("stream_day", oracle=_closed_sql(*_EVENTS, "day"))
def stream_day(t):
    return _closed(t, *_EVENTS, "date")


@query("stream_week", oracle=_closed_sql(*_EVENTS, "week"))
def stream_week(t):
    return _closed(t, *_EVENTS, "week")


@query("stream_month", oracle=_closed_sql(*_ORDERS, "month"))
def stream_month(t):
    return _closed(t, *_ORDERS, "month")
