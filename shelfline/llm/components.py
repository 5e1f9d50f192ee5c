"""Connected components over an edge table, by contracting it over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfline.plans.staging import Stage


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """(vertex, label): one label, a vertex of the component, for all of it. Vertices without an edge are left out.

    In each round a vertex takes its smallest neighbour, and that one's, if they are smaller; edges are renamed
    accordingly, and those within one name go. A star is done in one round, a chain halves. Minima are combined before
    the shuffle, so a vertex with many edges is no hot key; what is left of the edges shrinks from round to round.
    """
    left = stage(edges.where("a <> b").select("a", "b").distinct(), "edges")
    rounds: list[DataFrame] = []
    while not rounds or not left.isEmpty():
        both = left.union(left.select("b", "a"))
        near = stage(both.groupBy(F.col("a").alias("vertex")).agg(F.least(F.min("a"), F.min("b")).alias("near")), "near")
        heads = near.select(F.col("vertex").alias("_v"), F.col("near").alias("_n"))
        names = stage(near.join(heads, F.col("near") == F.col("_v")).select("vertex", F.col("_n").alias("label")), "names")
        rounds.append(names)
        new_a = names.select(F.col("vertex").alias("a"), F.col("label").alias("_a"))
        new_b = names.select(F.col("vertex").alias("b"), F.col("label").alias("_b"))
        left = stage(left.join(new_a, "a").join(new_b, "b").where("_a <> _b")
                     .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "edges")
    out = rounds.pop()
    while rounds:
        later = out.select(F.col("vertex").alias("_v"), F.col("label").alias("_l"))
        out = (rounds.pop().join(later, F.col("label") == F.col("_v"), "left")
               .select("vertex", F.coalesce("_l", "label").alias("label")))
    return out
