"""Connected components of an edge table, by stars."""

from pyspark.sql import DataFrame, functions as F

from tallyloom.session import materialise


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
    ).first()
    return row["n"], row["s"]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node on an edge; the component is its smallest node.

    Large and small star steps in turn: each hangs a node's neighbours on the smallest of them.
    The edge table never grows, every step is a minimum per node and a join back, and the number
    of steps grows with the logarithm of the longest path.
    """
    ends = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    ends = materialise(ends)
    before = _mark(ends)
    while True:
        both = ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ends = materialise(hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = _mark(ends)
        if after == before:
            break
        before = after
    return ends.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        ends.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
