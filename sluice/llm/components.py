"""Connected components of a graph given as an edge table, by alternating large and small stars.

Each round is an aggregate with map-side combine and a join; neighbours are never gathered in a
list, so a centre with very many neighbours is only a skewed join key, which adaptive execution
splits. Every round is written to the shared scratch folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sluice.scratch import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each neighbour of a node to the smallest node around it.

    Large: the neighbours above the node; small: those below it and the node itself.
    """
    if large:
        around = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # Stored, so that the join is one of two shuffles, of which a hot centre can be split.
    least = materialize(around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")), "least-neighbours")
    linked = around.join(least, "a")
    if large:
        out = linked.filter("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("root").alias("b")).unionAll(
            least.select("a", F.col("root").alias("b"))
        )
    return out.filter("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long, either order, repeats allowed) -> (node, root).

    One row per node that has a link to another; ``root`` is the smallest node of its component.
    Rows with a null end and links of a node to itself are no links; no edges give no rows.
    """
    links = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()
    links = materialize(links, "links")
    before = _mark(links)
    while True:
        links = materialize(_star(_star(links, True), False), "links")
        after = _mark(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
