"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum (combined before the shuffle) and an equi-join, so no
neighbourhood is ever gathered in one task and nothing is collected to the driver but
one row of convergence figures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from medialoom.llm.common import drop_path, materialise


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a, b) long pairs -> (node, label): label is the smallest node reachable.

    Nodes without an edge are absent; self-pairs and repeated pairs are harmless, and
    an empty input gives an empty result.
    """
    spark = edges.sparkSession
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e, path = materialise(e, "edges")
    before = _figures(e)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        nxt, new_path = materialise(_small_star(_large_star(e)), "edges")
        after = _figures(nxt)
        drop_path(spark, path)
        e, path = nxt, new_path
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    down = e.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return down.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def _figures(e: DataFrame) -> tuple:
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return (r.n, r.s)
