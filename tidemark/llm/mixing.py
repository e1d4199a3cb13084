"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are cut into equal blocks. Block k of a source with weight w (its share of all weights) may not run
before slot floor((k - 1) / w) and must run before slot ceil(k / w). Earliest deadline first over the released blocks puts one
block in every slot, and each block inside its window, so at every slot each source is less than one block away from its
target. Integer weights repeat after as many slots as they sum up to, so one period is scheduled and then used for all blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.llm import common

#: The lane of rows whose source is null or has no weight of its own.
OTHER = "(other)"
#: Longest period, in slots. The schedule of one period is a single small row, so it needs a bound.
MAX_PERIOD = 20_000


def _lanes(weights: dict[str, int], other: int) -> list[tuple[str, int]]:
    lanes = sorted([*weights.items(), (OTHER, other)])
    if any(not isinstance(w, int) or w < 1 for _, w in lanes):
        raise ValueError("weights are positive integers")
    if sum(w for _, w in lanes) > MAX_PERIOD:
        raise ValueError(f"weights sum up to more than {MAX_PERIOD}")
    return lanes


def _schedule_column(lanes: list[tuple[str, int]]) -> Column:
    """The lane number of each slot of one period, as an array: a fold that keeps every lane's count of placed blocks."""
    period, n = sum(w for _, w in lanes), len(lanes)
    weights = F.array(*(F.lit(w) for _, w in lanes))

    def step(state: Column, slot: Column) -> Column:
        # Next block of lane i: release floor(p * done / w), deadline ceil(p * (done + 1) / w); ties by lane.
        def candidate(done: Column, i: Column) -> Column:
            weight = F.element_at(weights, i + 1)
            release = F.floor(F.lit(period) * done / weight)
            deadline = F.ceil(F.lit(period) * (done + 1) / weight)
            return F.when(release <= slot, F.struct(deadline.alias("deadline"), i.alias("lane")))

        chosen = F.array_min(F.filter(F.transform(state["done"], candidate), lambda x: x.isNotNull()))["lane"]
        return F.struct(
            F.transform(state["done"], lambda done, i: done + F.when(i == chosen, 1).otherwise(0)).alias("done"),
            F.concat(state["lanes"], F.array(chosen)).alias("lanes"))

    start = F.struct(F.array_repeat(F.lit(0), n).alias("done"), F.array().cast("array<int>").alias("lanes"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), start, step, lambda state: state["lanes"])


def schedule(spark, weights: dict[str, int], other: int = 1) -> DataFrame:
    """One period: lane, weight, nth (1 to weight), slot (0 to period - 1), release and deadline of that block."""
    lanes = _lanes(weights, other)
    period = sum(w for _, w in lanes)
    slots = spark.range(1).select(F.posexplode(_schedule_column(lanes)).alias("slot", "i"))
    slots = slots.withColumn("nth", F.row_number().over(Window.partitionBy("i").orderBy("slot")))
    names, weight = F.array(*(F.lit(name) for name, _ in lanes)), F.element_at(F.array(*(F.lit(w) for _, w in lanes)), F.col("i") + 1)
    return slots.select(
        F.element_at(names, F.col("i") + 1).alias("lane"), weight.alias("weight"), "nth", "slot",
        F.floor(F.lit(period) * (F.col("nth") - 1) / weight).cast("int").alias("release"),
        F.ceil(F.lit(period) * F.col("nth") / weight).cast("int").alias("deadline"))


def place(docs: DataFrame, weights: dict[str, int], block_rows: int, other: int = 1) -> DataFrame:
    """Where each row of ``docs`` goes: doc_id, source, lane, block, offset, release, deadline, slot, and its row id.

    Rows of a lane are taken in order of doc_id (nulls first, then by file place). ``block`` counts from 1, ``offset`` from 0
    inside the block; slots are global. Reading by (slot, offset) is the mix: up to the slot where the first lane runs dry,
    each lane's blocks differ from weight times slots by less than one. No row is dropped: slots of a lane that ran dry stay empty.
    Rows with a null or unlisted source share the lane "(other)". Rows that repeat an id keep a place each; an empty table
    gives an empty result; text and columns of other names are not read.

    Positions inside a lane come from a range partitioning on lane, id and file place with counts per partition: no task sorts a whole
    lane, however ids are spread, null ids included.
    """
    spark = docs.sparkSession
    period = sum(w for _, w in _lanes(weights, other))
    known = F.col("source").isin(*weights) if weights else F.lit(False)
    rows = common.with_row_id(docs.select("doc_id", "source"), "row_id").select(
        "row_id", "doc_id", "source", F.when(known, F.col("source")).otherwise(F.lit(OTHER)).alias("lane"))
    numbered = common.numbered(rows, ["lane"], ["doc_id", "row_id"], "position", "total", "lanes")
    blocks = numbered.select(
        "row_id", "doc_id", "source", "lane", (F.floor(F.col("position") / block_rows) + 1).alias("block"),
        (F.col("position") % block_rows).alias("offset"))
    table = common.pin(schedule(spark, weights, other), "schedule").withColumnRenamed("lane", "planned")
    cycle = F.floor((F.col("block") - 1) / F.col("weight"))
    nth = (F.col("block") - 1) % F.col("weight") + 1
    weight_of = F.create_map(*(x for name, w in _lanes(weights, other) for x in (F.lit(name), F.lit(w))))
    blocks = blocks.withColumn("weight", weight_of[F.col("lane")]).withColumn("cycle", cycle).withColumn("nth_needed", nth)
    placed = blocks.join(table.drop("weight"), (F.col("lane") == F.col("planned")) & (F.col("nth_needed") == F.col("nth")))
    return placed.select(
        "row_id", "doc_id", "source", "lane", "block", "offset",
        *((F.col("cycle") * period + F.col(x)).alias(x) for x in ("release", "deadline", "slot")))


def mix(docs: DataFrame, weights: dict[str, int], block_rows: int, other: int = 1, places: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` in the order of the mix, as :func:`place` gives it; a range sort, so files are in order too.

    Readers of several files do not keep that order. With ``places`` it is part of the rows: columns lane, slot and offset are
    added, and take the place of columns already called so.
    """
    if not common.is_file_backed(docs):
        docs = common.pin(docs, "rows")
    added = ["lane", "slot", "offset"]
    key, *working = common.fresh(docs, "row", *added)
    order = place(docs, weights, block_rows, other).select(F.col("row_id").alias(key), *(F.col(c).alias(w) for c, w in zip(added, working)))
    rows = common.with_row_id(docs, key).join(order, key).sort(*working[1:])
    if not places:
        return rows.select(docs.columns)
    return rows.select(*(c for c in docs.columns if c.lower() not in added), *(F.col(w).alias(c) for c, w in zip(added, working)))
