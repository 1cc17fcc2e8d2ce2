"""Connected components of a graph given as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martlens.session import work_dir


def components(pairs: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that a pair (u, v) names.

    Each round every node points to its smallest neighbour if that is smaller than itself.  Pointers only
    go down, so they form trees; jumping over pointers, which halves the depth each time, finds their roots.  The roots
    then stand for their trees in the pairs that are left.  A round at least halves the nodes that still
    have a neighbour, so rounds grow with the logarithm of their number; a node with many neighbours is only ever
    aggregated.  Every step is a table in the working folder.
    """
    spark, folder = pairs.sparkSession, work_dir(pairs.sparkSession, "components")
    count = 0

    def kept(df: DataFrame) -> DataFrame:
        nonlocal count
        path, count = f"{folder}/{count}", count + 1
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def followed(rows: DataFrame, column: str, up: DataFrame) -> DataFrame:
        """`rows` with the node in `column` replaced by what `up` (node, above) says of it."""
        other = up.select(F.col("node").alias("_node"), F.col("above").alias("_above"))
        joined = rows.join(other, F.col(column) == F.col("_node"), "left")
        return joined.withColumn(column, F.coalesce("_above", column)).drop("_node", "_above")

    left = kept(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    ends = left.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    found = kept(ends.select("node", F.col("node").alias("root")))
    left = kept(left.where("u <> v"))
    while not left.isEmpty():
        up = kept(left.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("above")))
        while True:
            higher = kept(followed(up, "above", up))
            moved = higher.join(up.withColumnRenamed("above", "was"), "node").where("above <> was")
            up = higher
            if moved.isEmpty():
                break
        found = kept(followed(found, "root", up))
        ends = followed(followed(left, "u", up), "v", up)
        left = kept(ends.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    return found
