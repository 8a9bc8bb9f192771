"""Connected components of a link table, by joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustmill.llm.tables import free_finished_shuffles, saved


def min_labels(links: DataFrame) -> DataFrame:
    """``vertex, label`` for every vertex of ``links (a, b)``: the smallest vertex it reaches.

    Large-star and small-star steps in turn: every vertex hands its larger neighbours, then
    its smaller ones, to the smallest vertex around it. A star step is one aggregate and one
    join; their number grows with the logarithm of the longest chain. Vertices with many
    neighbours are met by partial aggregation and by splitting of skewed joins. All is done once
    no vertex with a smaller neighbour has another one, which one aggregate tells.
    """
    edges = saved(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        around = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        if around.filter("m < u AND n > 1").isEmpty():
            break
        least = around.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v")  # pairs that come twice go with the step's only distinct, below
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.filter("u != v").unionByName(down.select("u", F.col("m").alias("v"))).distinct()
        edges = saved(small)
        del both, around, least, large, down, small
        free_finished_shuffles(edges)
    labels = edges.select(F.col("u").alias("vertex"), F.col("v").alias("label"))
    roots = edges.select(F.col("v").alias("vertex"), F.col("v").alias("label")).distinct()
    return labels.unionByName(roots)
