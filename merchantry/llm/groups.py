"""Bounded groups of rows inside tasks, and connected components across tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantry.llm.rows import kept


def in_groups(df: DataFrame, keys: list[str], schema: str,
              run: Callable[[pa.Table], Iterator[pa.RecordBatch] | list[pa.RecordBatch]]) -> DataFrame:
    """``run`` over each group of equal ``keys`` (whole numbers, not null), which the caller keeps small.

    Rows are sorted by the keys, so a task holds one group beside one batch, and thousands of small groups
    cost one pass over arrays instead of a call of Spark each.
    """
    dealt = df.repartition(*keys).sortWithinPartitions(*keys)

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in arrow:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
            changed = np.zeros(batch.num_rows, bool)
            for c in columns:
                changed[1:] |= c[1:] != c[:-1]
            changed[0] = last is not None and last != tuple(c[0] for c in columns)
            last = tuple(c[-1] for c in columns)
            cuts = np.flatnonzero(changed).tolist()
            start = 0
            for cut in cuts:
                held.append(batch.slice(start, cut - start))
                yield from run(pa.Table.from_batches([h for h in held if h.num_rows]))
                held, start = [], cut
            held.append(batch.slice(start))
        if held:
            yield from run(pa.Table.from_batches(held))

    return dealt.mapInArrow(batches, schema)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of the edges (a, b): the smallest id reachable.

    Alternates two steps until nothing changes: each vertex hands the smallest neighbour to its larger
    ones, then to its smaller ones. Rounds grow with the logarithm of the longest path. Everything is
    aggregates and joins on one vertex; no task or driver holds a component.
    """
    ids = edges.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).filter("a <> b")
    current = kept(ids.select("a", "b").distinct(), "component-edges")
    mark = _mark(current)
    while True:
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        larger = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = larger.filter("a <> b").distinct()
        lowest = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(lowest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        following = kept(smaller.union(lowest.select("a", F.col("m").alias("b"))).distinct(), "component-edges")
        now = _mark(following)
        if now == mark:
            break
        current, mark = following, now
    return following.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        following.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Which of the pairs (a, b), in their order, join two trees over ``n`` points."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    chosen = np.zeros(len(a), bool)
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        rx, ry = find(x), find(y)
        if rx != ry:
            root[ry] = rx
            chosen[k] = True
    return chosen
