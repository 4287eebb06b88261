"""Connected components of a link table, as alternating star jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.session import bounded, materialise


def _to_least(links: DataFrame) -> DataFrame:
    """Links (u, v) with the least neighbour of u, m. The minimum is combined before the shuffle
    and joined back, so no node's links gather in one task."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(least, "u")


def components(links: DataFrame, a: str, b: str, rows: int | None = None) -> DataFrame:
    """(node, component): the least node reachable, for every node in a link between two nodes.

    Rounds alternate: each node hands its larger neighbours to its least one, then its smaller
    ones; the trees flatten in a logarithmic number of rounds. Every round is written to the
    shared folder, so a lost executor repeats one round at most. Links with a null end and from a
    node to itself are ignored. `rows`, if known, bounds the links; no round makes them more.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = edges.where("u > v").distinct()
    edges = materialise(edges if rows is None else bounded(edges, rows), "links")
    before, rows = None, edges.count()
    while True:
        both = edges.union(edges.select("v", "u"))
        large = _to_least(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = large.where("u > v").distinct()
        small = _to_least(large)
        small = small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v"))
        )
        edges = materialise(bounded(small.distinct(), rows), "links")
        total = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if total == before:
            break
        before = total
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )
