"""Gap-free ids and running totals against plain Python."""

import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from merchantry.functions import numbering


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    monkeypatch.setattr(numbering, "BLOCK_BITS", 3)


def test_running_total(spark):
    keys = random.Random(1).sample(range(-200, 5000), 500)
    data = [(k, k % 4) for k in keys]
    df = spark.createDataFrame(data, "k bigint, w bigint").repartition(7)
    got = {r.k: r.t for r in numbering.running_total(df, "k", F.col("w"), "t").collect()}
    ordered = sorted(data)
    want = dict(zip([k for k, _ in ordered], [0, *accumulate(w for _, w in ordered)]))
    assert got == want


def test_id_by_key_has_no_gaps(spark):
    df = spark.createDataFrame([(k * 37,) for k in range(300)], "k bigint").repartition(5)
    got = sorted((r.k, r.id) for r in numbering.id_by_key(df, "k", "id").collect())
    assert got == [(k * 37, k + 1) for k in range(300)]


def test_null_and_sparse_keys(spark, monkeypatch):
    """Null keys come last and lose no row; keys over the whole range of 64 bits, equal rows and several totals."""
    monkeypatch.setattr(numbering, "BLOCK_BITS", 18)
    keys = [-(2**63), -(2**40), -1, 0, 5, 2**20, 2**20 + 1, 2**37, 2**55, 2**63 - 1] + [k << 30 for k in range(1, 200)]
    data = [(k, i % 5) for i, k in enumerate(keys)] + [(None, 2)] * 4 + [(None, 7)]
    df = spark.createDataFrame(data, "k bigint, w bigint").repartition(6)
    got = sorted(((r.n, r.k, r.w, r.t) for r in numbering.running_totals(df, "k", {"n": F.lit(1), "t": F.col("w")}).collect()))
    assert [g[0] for g in got] == list(range(len(data)))
    keyed = sorted((k, w) for k, w in data if k is not None)
    assert [(g[1], g[2]) for g in got[: len(keyed)]] == keyed
    assert [g[3] for g in got] == [0, *accumulate(g[2] for g in got)][:-1]


def test_no_window_is_large(spark):
    """The plan has no window over all rows but the one over the top blocks."""
    df = spark.createDataFrame([(1,)], "k bigint")
    plan = numbering.id_by_key(df, "k", "id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == numbering.LEVELS + 1


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_id_by_order_with_a_hot_value(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        data = [("hot" if i % 3 else f"k{i % 7}", i * 7919 % 1009) for i in range(1000)]
        df = spark.createDataFrame(data, "k string, v bigint").repartition(6)
        got = sorted((r.id, r.k, r.v) for r in numbering.id_by_order(df, ["k", "v"], "id").collect())
        assert got == [(i + 1, *row) for i, row in enumerate(sorted(data))]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_id_by_order_splits_a_group_of_equal_rows(spark, tmp_path):
    spark.range(3000).selectExpr("IF(id % 3 = 0, 7, id) AS v").repartition(4).write.parquet(str(tmp_path / "copies"))
    numbered = numbering.id_by_order(spark.read.parquet(str(tmp_path / "copies")), ["v"], "id")
    got = sorted((r.id, r.v) for r in numbered.collect())
    assert got == [(i + 1, v) for i, v in enumerate(sorted(7 if i % 3 == 0 else i for i in range(3000)))]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        copies = spark.read.parquet(str(tmp_path / "copies")).withColumn("_copy", F.monotonically_increasing_id())
        tasks = copies.repartitionByRange(8, "v", "_copy").select("v", F.spark_partition_id().alias("task"))
        assert tasks.filter("v = 7").select("task").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_id_by_order_moves_no_column_that_decides_nothing(spark, tmp_path, monkeypatch):
    """Rows that agree up to the last wanted column are alike in the result, so the columns behind it stay where they are."""
    data = [(i % 5, i % 3, i % 2, f"t{i % 7}", i) for i in range(210)]
    spark.createDataFrame(data, "k bigint, n bigint, v bigint, tail string, other bigint").write.parquet(str(tmp_path / "wide"))
    moved = []
    monkeypatch.setattr(numbering, "settle", lambda df, real=numbering.settle: moved.append(df) or real(df))
    numbered = numbering.id_by_order(spark.read.parquet(str(tmp_path / "wide")), ["k", "n", "v", "tail"], "id", columns=["k", "v"])
    got = sorted((r.id, r.k, r.v) for r in numbered.collect())
    assert got == [(i + 1, k, v) for i, (k, n, v) in enumerate(sorted(row[:3] for row in data))]
    plan = moved[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "tail" not in plan.split("Relation")[0] and "other" not in plan.split("Relation")[0]
