"""Running totals and gap-free ids without pulling the table into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchantry.sources.store import settle, unbroadcast

# a key of 63 bits is cut into three blocks of this many bits; ten bits are left for the top
BLOCK_BITS = 18
LEVELS = 3
ROW_BITS = 33


def _before(names: list[str], window) -> list[Column]:
    return [F.coalesce(F.sum(n).over(window), F.lit(0)) for n in names]


def running_totals(df: DataFrame, key: str, weights: dict[str, Column]) -> DataFrame:
    """Add, per name, the total weight of all rows with a smaller ``key``; ``key`` is a unique whole number.

    Rows are summed inside blocks of 2^18 keys, the blocks inside blocks of 2^36, these inside blocks of 2^54,
    of which there are at most 2^10: however the keys are spread, no window holds more than 2^18 rows. Rows with a null key
    come last, in the order of a hash of their columns.
    """
    n = len(weights)
    sums, totals = [f"_w{i}" for i in range(n)], [f"_t{i}" for i in range(n)]
    number = F.coalesce(F.col(f"`{key}`").cast("bigint"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    rows = df.select("*", F.col(f"`{key}`").isNull().alias("_last"), number.alias("_b0"),
                     *[w.cast("bigint").alias(s) for w, s in zip(weights.values(), sums)])
    rows = rows.withColumn("_b1", F.shiftright("_b0", BLOCK_BITS))
    sizes = [rows]
    for level in range(1, LEVELS + 1):
        block = sizes[-1].groupBy("_last", f"_b{level}").agg(*[F.sum(s).alias(s) for s in sums])
        sizes.append(block.withColumn(f"_b{level + 1}", F.shiftright(f"_b{level}", BLOCK_BITS)) if level < LEVELS else block)
    upto = (Window.unboundedPreceding, -1)
    # at most 2^10 rows, twice with null keys
    top = Window.orderBy("_last", f"_b{LEVELS}").rowsBetween(*upto)
    starts = sizes[LEVELS].select("_last", f"_b{LEVELS}", *[c.alias(t) for c, t in zip(_before(sums, top), totals)])
    for level in range(LEVELS - 1, -1, -1):
        outer = ["_last", f"_b{level + 1}"]
        inside = Window.partitionBy(*outer).orderBy(f"_b{level}").rowsBetween(*upto)
        # both sides are sorted by block already; the rows themselves must never be broadcast
        own = unbroadcast(sizes[level].withColumns({f"_o{i}": c for i, c in enumerate(_before(sums, inside))})).join(starts, outer)
        keep = [F.col(f"`{c}`") for c in df.columns] if level == 0 else [F.col("_last"), F.col(f"_b{level}")]
        starts = own.select(*keep, *[(F.col(t) + F.col(f"_o{i}")).alias(list(weights)[i] if level == 0 else t) for i, t in enumerate(totals)])
    return starts


def running_total(df: DataFrame, key: str, weight: Column, name: str) -> DataFrame:
    return running_totals(df, key, {name: weight})


def id_by_key(df: DataFrame, key: str, name: str, first: int = 1) -> DataFrame:
    """Gap-free ids from ``first`` in the order of a unique whole-number ``key``."""
    return running_total(df, key, F.lit(1), "_before").withColumn(name, F.col("_before") + first).drop("_before")


def id_by_order(df: DataFrame, order: list[str], name: str, first: int = 1, columns: list[str] | None = None) -> DataFrame:
    """Gap-free ids in the order of any columns, for tables without a whole-number key.

    Range partitioning on all the columns splits a hot leading value, and the row position as a last
    column splits even a large group of equal rows (which may take their ids in any order). ``df`` should
    be a scan, so that positions are the same when a task is repeated. The ranges are sampled: the
    ranged rows are settled, and each read of the result adds the start of the range to the position in it.
    Columns of ``order`` that are not wanted further can be dropped from the result: the stored rows are read by column. With
    ``columns`` only these are stored, and what comes in ``order`` after the last of them is not moved: rows that are alike
    up to there are alike in the result.
    """
    if columns and set(columns) <= set(order):
        order = order[: max(map(order.index, columns)) + 1]
    by = [*order, "_copy"]
    ranged = (
        df.select(*({c: None for c in [*order, *columns]} if columns else ["*"]), F.monotonically_increasing_id().alias("_copy"))
        .repartitionByRange(*by).sortWithinPartitions(*by).drop("_copy")
        .select(*(columns or ["*"]), F.monotonically_increasing_id().alias("_at"))
    )
    return _positions(settle(ranged), name, first)


def _positions(settled: DataFrame, name: str, first: int) -> DataFrame:
    ranged = settled.withColumn("_range", F.shiftright("_at", ROW_BITS))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    row = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    # one row per shuffle partition
    return (
        ranged.join(F.broadcast(settle(starts)), "_range")
        .withColumn(name, F.col("_start") + row + first)
        .drop("_range", "_at", "_start")
    )
