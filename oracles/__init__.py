"""SQL for another engine that answers every query independently, to check the Spark plans."""

from __future__ import annotations

from oracles import gold, quality, raw, reports, silver
from oracles.layers import with_layers


def all_sql() -> dict[str, str]:
    """Query name -> one statement over the test tables."""
    bodies = {**raw.QUERIES, **quality.QUERIES, **silver.QUERIES, **gold.QUERIES, **reports.QUERIES}
    return {name: with_layers(body) for name, body in bodies.items()}
