"""Joins that stay exact and balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _same(left: DataFrame, right: DataFrame, keys: Iterable[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def new_rows_only(incoming: DataFrame, stored: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Incoming rows whose composite key is not stored; null matches null.

    Stored keys are made distinct first, which folds a hot key to one row per task.
    """
    keys = list(keys)
    known = stored.select(*keys).distinct()
    return incoming.join(known, _same(incoming, known, keys), "left_anti")


def rows_with_keys(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in the other frame."""
    return df.join(other.select(key).distinct(), key, "left_semi")


def parents_with_children(parents: DataFrame, children: DataFrame, key: str, newest_by: str,
                          child_order: Iterable[str]) -> DataFrame:
    """Parents newest first, each followed by its children in order; childless parents once.

    The listing is flat rows in sort order, so a parent with very many children is spread over
    tasks. An outer join cannot split a hot key on the child side; an inner join (split by AQE)
    plus the childless parents can.
    """
    matched = parents.join(children, key)
    childless = parents.join(children.select(key).distinct(), key, "left_anti")
    listing = matched.unionByName(childless, allowMissingColumns=True)
    return listing.orderBy(F.col(newest_by).desc_nulls_last(), F.col(key), *child_order)


def lookup_with_default(df: DataFrame, dimension: DataFrame, key: str, dimension_key: str,
                        defaults: dict[str, object]) -> DataFrame:
    """Left lookup on a dimension with unique keys; columns without a match take their default."""
    dim = dimension.select(F.col(dimension_key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in defaults])
    joined = df.join(dim, df[key] == dim["__key"], "left")
    return joined.select(*[df[c] for c in df.columns],
                         *[F.coalesce(F.col(f"__{c}"), F.lit(v)).alias(c) for c, v in defaults.items()])


def outer_by_name(left: DataFrame, right: DataFrame, key: str, fallback: str) -> DataFrame:
    """Full outer join on ``key``; the right side may carry it under the ``fallback`` name."""
    if key not in right.columns and fallback in right.columns:
        right = right.withColumn(key, F.col(fallback))
    return left.join(right, key, "full")


def upsert(target: DataFrame, incoming: DataFrame, keys: Iterable[str], force: bool, order: Iterable[str] = ()) -> DataFrame:
    """Target with the incoming rows: absent keys are added, present ones replaced with ``force``.

    Two anti joins; neither side is multiplied. When a key can repeat in the incoming rows, ``order``
    says in which sequence they arrive: the last one counts with ``force``, else the first.
    """
    keys, order = list(keys), list(order)
    if order:
        stamp = F.struct(*order)
        pick = F.max_by if force else F.min_by
        rest = [c for c in incoming.columns if c not in keys]
        one = incoming.groupBy(*keys).agg(pick(F.struct(*rest), stamp).alias("__row"))
        incoming = one.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in incoming.columns])
    incoming = incoming.select(*target.columns)
    if force:
        return new_rows_only(target, incoming, keys).unionByName(incoming)
    return target.unionByName(new_rows_only(incoming, target, keys))
