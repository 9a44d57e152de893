"""Connected components of an edge table, by hooking to smaller neighbours.

Every round each vertex hooks to its smallest neighbour if that is smaller; chains of
hooks are shortened by joins until they end at a root; edges are rewritten to roots and
those inside one root vanish. A vertex with millions of neighbours is a minimum over
partial minima and a join whose hot key adaptive execution splits; no group of
neighbours is ever gathered. Roots are the smallest ids of their components.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.sources.stage import materialise


def _to_roots(hooks: DataFrame) -> DataFrame:
    """Follows (v, root) hooks to the end; hooks lead to smaller ids, so there is one."""
    while True:
        up = hooks.select(F.col("v").alias("root"), F.col("root").alias("next"))
        longer = hooks.join(up, "root", "left").select(
            "v", F.coalesce("next", "root").alias("root"), (F.col("next") < F.col("root")).alias("moved")
        )
        longer = materialise(longer, "graph-hooks")
        hooks = longer.select("v", "root")
        if longer.where("moved").isEmpty():
            return hooks


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (a, b); vertices without edge are absent."""
    spark = edges.sparkSession
    edges = materialise(
        edges.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "graph-edges",
    )
    found = spark.createDataFrame([], "v bigint, root bigint")
    first = True
    while not edges.isEmpty():
        # a < b: only b can hook
        both = edges.select(F.col("b").alias("v"), F.col("a").alias("root")).union(
            edges.select(F.col("a").alias("v"), F.col("a").alias("root"))
        )
        roots = _to_roots(materialise(both.groupBy("v").agg(F.min("root").alias("root")), "graph-hooks"))
        if first:
            found, first = roots, False
        else:
            step = roots.select(F.col("v").alias("root"), F.col("root").alias("next"))
            found = materialise(
                found.join(step, "root", "left").select("v", F.coalesce("next", "root").alias("root")),
                "graph-roots",
            )
        a = roots.withColumnsRenamed({"v": "a", "root": "ra"})
        b = roots.withColumnsRenamed({"v": "b", "root": "rb"})
        edges = materialise(
            edges.join(a, "a")
            .join(b, "b")
            .where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct(),
            "graph-edges",
        )
    return found
