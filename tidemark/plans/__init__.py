"""Registered queries: one per operator, each with its SQL twin where SQL can state it."""

from tidemark.tables import NamedQueries

REGISTRY = NamedQueries()
query = REGISTRY.add


def load_all() -> NamedQueries:
    from tidemark.plans import (  # noqa: F401
        aggregations, joins, loads, models, projections, rankings, reshapes, retrieval,
        scalars, sources, streams, windows,
    )
    return REGISTRY
