"""Hierarchies of any depth: tables whose rows name their parent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantry.sources.store import remove, scratch_path


def roots(nodes: DataFrame, key: str, parent: str) -> DataFrame:
    """Per node its root, its depth below that root (0 for the root) and whether its way up ends in a cycle.

    Pointer doubling: every node knows an ancestor and the steps to it, and each round asks that ancestor for its own, so a
    chain of d nodes takes log2(d) rounds of one join over the nodes that have not arrived. Rounds are written out, so a lost
    executor costs a round at most. A parent that is null or not in the table makes a root. Nodes in or below a cycle have
    null ``root`` and ``depth``. Rows with a null key are left out; of rows with equal keys the smallest parent counts.
    """
    spark = nodes.sparkSession
    folder = scratch_path(spark, "hierarchy")
    one = nodes.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("node")).agg(F.min(parent).alias("up"))
    known = one.select(F.col("node").alias("up"), F.lit(True).alias("open"))
    state = one.join(known, "up", "left").select(
        "node", F.when(F.col("open"), F.col("up")).otherwise(F.col("node")).alias("top"),
        F.when(F.col("open"), 1).otherwise(0).cast("bigint").alias("steps"), F.coalesce("open", F.lit(False)).alias("open"),
    )

    def written(df: DataFrame, turn: int) -> DataFrame:
        df.write.parquet(f"{folder}/{turn}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{turn}")

    state = written(state, 0)
    reach, turn, size = 1, 0, state.count()
    # a way up without a cycle has fewer steps than there are nodes
    while reach < size and not state.filter("open").isEmpty():
        above = state.select(F.col("node").alias("top"), F.col("top").alias("_top"), F.col("steps").alias("_steps"),
                             F.col("open").alias("_open"))
        moved = state.filter("open").join(above, "top").select(
            "node", F.col("_top").alias("top"), (F.col("steps") + F.col("_steps")).alias("steps"), F.col("_open").alias("open")
        )
        state = written(state.filter("NOT open").unionByName(moved), turn + 1)
        remove(spark, f"{folder}/{turn}")
        reach, turn = reach * 2, turn + 1
    return state.select(
        F.col("node").alias(key), F.when(~F.col("open"), F.col("top")).alias("root"),
        F.when(~F.col("open"), F.col("steps")).alias("depth"), F.col("open").alias("in_cycle"),
    )
