"""Polygon centroids by the shoelace formula, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ring_sums(ring) -> Column:
    """Struct of twice the signed area and the two first moments of a closed ring."""
    ahead = F.slice(ring, F.lit(2), F.size(ring))
    edges = F.filter(F.arrays_zip(ring.alias("a"), ahead.alias("b")), lambda e: e["b"].isNotNull())

    def cross(edge):
        return edge["a"]["lon"] * edge["b"]["lat"] - edge["b"]["lon"] * edge["a"]["lat"]

    def total(term):
        return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + term(e))

    return F.struct(
        total(cross).alias("area2"),
        total(lambda e: (e["a"]["lon"] + e["b"]["lon"]) * cross(e)).alias("mx"),
        total(lambda e: (e["a"]["lat"] + e["b"]["lat"]) * cross(e)).alias("my"),
    )


def centroid(rings) -> Column:
    """``{lat, lon}`` of closed rings ``array<array<struct<lon, lat>>>``, parts weighted by area.

    Rings of one shape wind the same way; no area gives null.
    """
    sums = F.transform(rings, _ring_sums)

    def total(name):
        return F.aggregate(sums, F.lit(0.0), lambda acc, s: acc + s[name])

    area = F.nullif(total("area2"), F.lit(0.0)) * F.lit(3.0)
    return F.struct((total("my") / area).alias("lat"), (total("mx") / area).alias("lon"))
