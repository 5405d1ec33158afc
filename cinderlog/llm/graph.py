"""Connected components by alternating small-star and large-star steps, as DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _done(e: DataFrame) -> bool:
    """Whether e is a forest of stars: each node hangs on one other, on which only roots are hung."""
    ends = e.select(F.explode(F.array(F.struct(F.col("u").alias("id"), F.lit(1).alias("below")), F.struct(F.col("v").alias("id"), F.lit(0).alias("below")))).alias("x")).select("x.*")
    per = ends.groupBy("id").agg(F.sum("below").alias("below"), F.count("*").alias("n"))
    return per.where("below > 1 or below = 1 and n > 1").limit(1).count() == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (a, b): any orderable type, either direction, repeats and loops allowed, nulls ignored.

    Returns (id, component): each id that has an edge to another, with the smallest id it can reach; no rows without edges.
    Every step keeps the graph connected and writes its edges to the shared folder, so that lineage
    stays one step long. No step gathers the neighbours of a node: a hot node costs a partial
    minimum and a join whose sides are plain scans, which adaptive execution can split.
    """
    e = materialize(
        edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    while not _done(e):
        # small-star: a node and its smaller neighbours hang on the smallest of them
        j = e.join(e.groupBy("u").agg(F.min("v").alias("p")), "u")
        hung = j.select(F.explode(F.array(F.struct(F.col("u"), F.col("p").alias("v")), F.struct(F.col("v").alias("u"), F.col("p").alias("v")))).alias("x")).select("x.u", "x.v").where("u <> v").distinct()
        # large-star: larger neighbours of a node hang on its smallest neighbour
        up = hung.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("p"))
        e = materialize(hung.join(up, "v", "left").select("u", F.coalesce("p", "v").alias("v")).distinct(), "edges")
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
