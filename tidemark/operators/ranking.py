"""Positions, top rows and pages, none of which puts a whole group into one task."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import pin


def top_per_key(df: DataFrame, keys: Iterable[str], order: Iterable[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows per key.

    ``rank <= n`` lets Spark keep at most ``n`` rows per key in every task before the shuffle
    (WindowGroupLimit), so a hot key sends ``n`` rows per task and not all of its rows. ``order``
    must end in a unique column.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window).cast("bigint")).filter(F.col(rank) <= n)


# Above this many rows a key's positions are made from many partitions instead of one sort.
HOT_ROWS = 100_000


def with_positions(df: DataFrame, keys: Iterable[str], order: Iterable[str], position: str = "position",
                   descending: bool = False, hot_rows: int | None = None) -> DataFrame:
    """Position from 1 within each key, exact, for groups of any size.

    Keys of at most ``hot_rows`` rows take a window, one sort of bounded size per key. Larger keys,
    found by a count of the key columns alone, and the case without keys go through
    :func:`spread_positions`. ``order`` columns must be unique within a key.
    """
    keys, order = list(keys), list(order)
    if not keys:
        return spread_positions(df, keys, order, position, descending)
    window = Window.partitionBy(*keys).orderBy(*_sorting(order, descending))
    row_number = F.row_number().over(window).cast("bigint")
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    hot = pin(sizes.filter(F.col("__rows") > (HOT_ROWS if hot_rows is None else hot_rows)).select(*keys))
    if hot.isEmpty():
        return df.withColumn(position, row_number)
    match = F.lit(True)
    for key in keys:
        match = match & df[key].eqNullSafe(hot[key])
    usual = df.join(hot, match, "left_anti").withColumn(position, row_number)
    return usual.unionByName(spread_positions(df.join(hot, match, "left_semi"), keys, order, position, descending))


def _sorting(order: list[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def spread_positions(df: DataFrame, keys: list[str], order: list[str], position: str = "position",
                     descending: bool = False) -> DataFrame:
    """Positions per key without putting a key into one task.

    A range partitioning on keys and order columns cuts a hot key into many partitions; each row
    gets its offset within its partition, and the small table of row counts by (partition, key)
    gives what comes before it. The partition number is placement, so the rows are pinned first.
    """
    sort = [F.col(k) for k in keys] + _sorting(order, descending)
    low_bits = F.lit((1 << 33) - 1)
    placed = pin(
        df.repartitionByRange(*sort).sortWithinPartitions(*sort)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__row", F.monotonically_increasing_id().bitwiseAND(low_bits))
    )
    pieces = placed.groupBy("__part", *keys).agg(F.count(F.lit(1)).alias("__rows"), F.min("__row").alias("__first"))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        F.col("__part").alias("__piece"), *[F.col(k).alias(f"__k_{k}") for k in keys],
        (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first") + 1).alias("__shift"),
    )
    match = placed["__part"] == offsets["__piece"]
    for k in keys:
        match = match & placed[k].eqNullSafe(offsets[f"__k_{k}"])
    joined = placed.join(offsets, match)
    return joined.select(*[placed[c] for c in df.columns], (placed["__row"] + offsets["__shift"]).alias(position))


def batch_numbers(df: DataFrame, order: Iterable[str], size: int, batch: str = "batch") -> DataFrame:
    """Consecutive groups of ``size`` rows, numbered from 0."""
    placed = with_positions(df, [], order)
    return placed.withColumn(batch, F.floor((F.col("position") - 1) / F.lit(size)).cast("bigint"))


def page_count(total: Column, size: int) -> Column:
    return F.ceil(total / F.lit(size)).cast("bigint")


def list_chunks(df: DataFrame, keys: Iterable[str], value: str, order: Iterable[str], size: int) -> DataFrame:
    """Ordered value lists per key in chunks of at most ``size``: ``keys, chunk, items``.

    All values are kept; a list of unbounded length never forms in one row.
    """
    keys = list(keys)
    placed = with_positions(df.select(*dict.fromkeys([*keys, value, *order])), keys, order)
    chunked = placed.withColumn("chunk", F.floor((F.col("position") - 1) / F.lit(size)).cast("bigint"))
    pairs = F.sort_array(F.collect_list(F.struct("position", value)))
    return chunked.groupBy(*keys, "chunk").agg(F.transform(pairs, lambda p: p[value]).alias("items"))


def rank_band(counts: DataFrame, key: str, word: str, count: str, low: str = "0.7", high: str = "0.8",
              take: int = 15) -> DataFrame:
    """Words between two fractions of the frequency ranking, rarest first, at most ``take`` per key.

    Keeps positions ``int(low*n)`` up to ``int(high*n)`` counted from 0, by count then word. The
    bounds are decimals, so that 0.7 of a multiple of ten is exact.
    """
    counts = pin(counts.select(key, word, count))
    totals = counts.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
    placed = with_positions(counts, [key], [count, word])
    index = F.col("position") - 1
    first = F.floor(F.col("__n") * F.lit(low).cast("decimal(5,4)"))
    last = F.floor(F.col("__n") * F.lit(high).cast("decimal(5,4)"))
    return (
        placed.join(totals, F.col(key) == F.col("__key"))
        .filter((index >= first) & (index < last) & (index < first + take))
        .select(key, word, count, (index - first + 1).cast("bigint").alias("rank"))
    )


def page(df: DataFrame, order: Iterable[str], number: int, size: int = 5) -> DataFrame:
    """Page ``number`` in key order with its page number; past the end gives the last page.

    Only the key columns are ranked; the few keys of the page then pick the whole rows.
    """
    order = list(order)
    placed = with_positions(df.select(*order), [], order)
    pages = placed.agg(F.greatest(page_count(F.count(F.lit(1)), size), F.lit(1))).scalar()
    wanted = F.greatest(F.least(F.lit(number).cast("bigint"), pages), F.lit(1).cast("bigint"))
    numbered = placed.withColumn("page", F.ceil(F.col("position") / F.lit(size)).cast("bigint"))
    chosen = pin(numbered.filter(F.col("page") == wanted))
    return df.join(chosen, order).orderBy("position").select(*df.columns, "page")


def newest(df: DataFrame, order: Iterable[Column], n: int) -> DataFrame:
    """The first ``n`` rows overall (TakeOrderedAndProject: ``n`` rows per task)."""
    return df.orderBy(*order).limit(n)


def top_per_measure(df: DataFrame, label: str, measures: Iterable[str], k: int) -> DataFrame:
    """The ``k`` largest labels of each measure column, label order breaking ties."""
    long = df.unpivot([label], list(measures), "measure", "amount").filter(F.col("amount").isNotNull())
    return top_per_key(long, ["measure"], [F.col("amount").desc(), F.col(label).asc()], k)


def cascade(df: DataFrame, key: str, value: str, spread: Column, first: int, second: int) -> DataFrame:
    """All rows of the ``second`` keys with the largest ``spread`` among the ``first`` by mean value."""
    stats = df.groupBy(key).agg(F.avg(value).alias("__mean"), spread.alias("__spread"))
    by_mean = stats.orderBy(F.col("__mean").desc(), F.col(key)).limit(first)
    chosen = by_mean.orderBy(F.col("__spread").desc_nulls_last(), F.col(key)).limit(second).select(key)
    return df.join(chosen, key, "left_semi")


def first_per_category(df: DataFrame, category: str, order: str, columns: Iterable[str]) -> DataFrame:
    """The row with the smallest ``order`` of each category, by partial aggregation."""
    fields = [order, *columns]
    head = F.min(F.struct(*fields)).alias("head")
    return df.groupBy(category).agg(head).select(category, *[F.col(f"head.{c}") for c in fields])


def latest_per_key(df: DataFrame, keys: Iterable[str], order: Iterable[str]) -> DataFrame:
    """The newest row per primary key; partial aggregation keeps one row per key and task."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest_row = F.max_by(F.struct(*order, *rest) if rest else F.struct(*order), F.struct(*order)).alias("r")
    grouped = df.groupBy(*keys).agg(newest_row)
    return grouped.select(*[F.col(c) if c in keys else F.col(f"r.{c}") for c in df.columns])


def chronological_split(df: DataFrame, key: str, order: Iterable[str], tenths: int = 8) -> DataFrame:
    """``part`` is ``train`` for the first ``int(n * tenths / 10)`` rows of each series, else ``test``."""
    totals = df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
    placed = with_positions(df, [key], order)
    limit = F.floor(F.col("__n") * tenths / F.lit(10).cast("decimal(3,0)"))
    part = F.when(F.col("position") <= limit, "train").otherwise("test")
    return placed.join(totals, F.col(key).eqNullSafe(F.col("__key"))).withColumn("part", part).drop("__key", "__n", "position")


def repeatable_split(df: DataFrame, keys: Iterable[str], share: float = 0.8, seed: int = 42) -> DataFrame:
    """Random split that depends on the key and seed only, so a rerun of a lost task agrees."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 1_000_000
    return df.withColumn("part", F.when(draw < int(share * 1_000_000), "train").otherwise("test"))
