"""Files laid out by several columns: same rows, and ranges and lookups that read few of them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from merchantry.sources.clustered import interleaved, write_clustered
from merchantry.sources.store import scratch_path


def scanned(df):
    """The rows that the scan of a collected plan gave to the filter."""
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else plan
    leaves = plan.collectLeaves()
    assert leaves.size() == 1
    return len(rows), leaves.head().metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def wide(spark):
    """200,000 rows: two columns without relation, a third of all rows of one value in each, and a key of its own order."""
    n = 200_000
    spread = lambda seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1_000_000))
    df = spark.range(n).select(
        F.pmod(F.xxhash64("id", F.lit(9)), F.lit(1 << 40)).alias("key"),
        F.when(F.col("id") % 3 == 0, 77).otherwise(spread(1)).alias("a"),
        F.date_from_unix_date(F.when(F.col("id") % 3 == 1, 77).otherwise(F.pmod(spread(2), F.lit(20_000))).cast("int")).alias("b"),
    )
    source, path = scratch_path(spark, "plain"), scratch_path(spark, "clustered")
    df.write.parquet(source)
    df = spark.read.parquet(source)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    write_clustered(df, path, ["a", "b"], ["key"], row_group=64 * 1024)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return df, spark.read.parquet(path), n


def test_rows_and_columns_stay(wide):
    df, laid, n = wide
    assert laid.columns == df.columns and laid.dtypes == df.dtypes and laid.count() == n
    assert laid.exceptAll(df).isEmpty()


@pytest.mark.parametrize("condition", [
    "a BETWEEN 300000 AND 330000",
    "b BETWEEN DATE '1990-01-01' AND DATE '1991-12-31'",
    "a BETWEEN 300000 AND 400000 AND b > DATE '2020-01-01'",
])
def test_ranges_of_either_column_read_part(wide, condition):
    df, laid, n = wide
    found, read = scanned(laid.filter(condition))
    assert found == df.filter(condition).count() > 0
    assert read < n / 3


def test_lookup_reads_few_groups(wide):
    df, laid, n = wide
    key = df.first().key
    found, read = scanned(laid.filter(F.col("key") == key))
    assert found == 1 and read < n / 10
    inside = df.filter(f"key > {key}").agg(F.min("key")).first()[0] - 1
    assert scanned(laid.filter(F.col("key") == inside)) in [(0, r) for r in range(n // 10)] or inside == key


def test_hot_value_is_split(spark, wide):
    """No file holds more than its share although a third of all rows has one value."""
    _, laid, n = wide
    sizes = [r["count"] for r in laid.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 1.5 * n / len(sizes)


def test_curve_and_odd_tables(spark):
    kinds = "i int, f double, d date, t timestamp_ntz"
    data = [(None, None, None, None), (1, float("nan"), dt.date(1960, 1, 1), dt.datetime(2024, 3, 31, 2, 30)),
            (1, 2.5, dt.date(2024, 2, 29), dt.datetime(1950, 1, 1)), (7, -1.0, None, None)] * 5
    df = spark.createDataFrame(data, kinds)
    for some in (df, df.limit(0), df.filter("i IS NULL")):
        path = scratch_path(spark, "odd")
        write_clustered(some, path, ["i", "f", "d", "t"])
        assert spark.read.parquet(path).exceptAll(some).isEmpty() and spark.read.parquet(path).count() == some.count()
    line = spark.range(1000)
    order = [r[0] for r in line.select("id", interleaved(line, "id").alias("z")).orderBy("z", "id").select("id").collect()]
    assert order == list(range(1000))
    with pytest.raises(TypeError):
        write_clustered(spark.createDataFrame([("x",)], "s string"), scratch_path(spark, "odd"), ["s"])
    with pytest.raises(ValueError):
        write_clustered(df, scratch_path(spark, "odd"), [])
    clash = df.withColumnRenamed("i", "_curve").withColumnRenamed("f", "_at")
    path = scratch_path(spark, "odd")
    write_clustered(clash, path, ["_curve", "d"])
    assert spark.read.parquet(path).columns == clash.columns
