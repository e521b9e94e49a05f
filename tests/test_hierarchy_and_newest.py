"""Hierarchies of any depth, mergeable distinct counts, and the newest rows without reading all."""

import datetime as dt
import random
import shutil

import pytest
from pyspark.sql import functions as F

from merchantry.operators.bitmaps import bitmaps, counted, merged
from merchantry.operators.hierarchy import roots
from merchantry.plans import relational, starry
from merchantry.plans.common import months_of
from merchantry.sources.store import MONTH, scratch_path


def test_roots_of_chains_cycles_and_gaps(spark, rows):
    edges = [(i, i - 1 if i > 1 else None) for i in range(1, 8)]          # 7 is six steps below 1
    edges += [(20, 21), (21, 22), (22, 20), (23, 20), (24, 23)]            # a cycle and what hangs below it
    edges += [(30, 30), (40, 99), (None, 1), (50, 4), (50, 2), (50, None)]
    got = {r[0]: tuple(r)[1:] for r in rows(roots(spark.createDataFrame(edges, "id long, up long"), "id", "up"))}
    want = {i: (1, i - 1, False) for i in range(1, 8)}
    want |= {i: (None, None, True) for i in (20, 21, 22, 23, 24, 30)} | {40: (40, 0, False), 50: (1, 2, False)}
    assert got == want


def test_roots_of_nothing(spark):
    assert roots(spark.createDataFrame([], "id long, up long"), "id", "up").collect() == []
    assert [tuple(r) for r in roots(spark.createDataFrame([(1, 1)], "id long, up long"), "id", "up").collect()] == [(1, None, None, True)]


def test_roots_against_walks(spark, rows):
    draw = random.Random(4)
    up = {i: draw.choice([None, draw.randrange(400), draw.randrange(max(i, 1))]) for i in range(400)}
    want = []
    for node in up:
        seen, at = [node], node
        while up[at] is not None and up[at] not in seen:
            at = up[at]
            seen.append(at)
        want.append((node, at, len(seen) - 1, False) if up[at] is None else (node, None, None, True))
    got = rows(roots(spark.createDataFrame(list(up.items()), "id long, up long"), "id", "up"))
    assert sorted(got) == sorted(want)
    assert {len(w) for w in want} == {4} and any(w[3] for w in want) and max(w[2] or 0 for w in want) > 4


def test_bitmaps_count_as_distinct_counts(spark, rows):
    draw = random.Random(5)
    data = [(draw.choice("abc"), draw.choice(["x", "y", None]), draw.choice([None, 0, -1, -40000, 32768, 32769, 10**12, draw.randrange(99999)]))
            for _ in range(3000)]
    df = spark.createDataFrame(data, "big string, small string, id long")
    sets = bitmaps(df, "id", "big", "small")
    for keys in (["big", "small"], ["big"], ["small"], []):
        assert rows(counted(sets, "n", *keys)) == rows(df.groupBy(*keys).agg(F.count_distinct("id").alias("n")))
    assert merged(merged(sets, "big"), "big").count() == merged(sets, "big").count()
    assert counted(bitmaps(df.limit(0), "id", "big"), "n", "big").collect() == []


@pytest.fixture
def model(spark):
    """A star of 12 months with 20 facts a month, stored by month; every second user and every fifth product is unknown."""
    first = dt.date(2024, 1, 1)
    dates = spark.createDataFrame([(i + 1, first + dt.timedelta(i)) for i in range(366)], "date_id long, full_date date")
    facts = spark.range(240).select(
        F.col("id").alias("fact_id"), F.col("id").alias("order_id"), (F.col("id") % 7).alias("user_id"),
        (F.col("id") % 10).alias("product_id"), (F.expr("id DIV 20") * 30 + F.col("id") % 5 + 1).alias("date_id"),
        F.lit(1).alias("quantity"), F.col("id").cast("decimal(12,2)").alias("total_amount"),
    ).join(dates, "date_id").withColumn(MONTH, F.year("full_date") * 100 + F.month("full_date")).drop("full_date")
    path = scratch_path(spark, "facts")
    facts.repartition(MONTH).write.partitionBy(MONTH).parquet(path)
    users = spark.range(0, 7, 2).withColumnRenamed("id", "user_id")
    products = spark.range(10).filter("id % 5 <> 0").withColumnRenamed("id", "product_id")
    stored = spark.read.schema(facts.schema).parquet(path)
    return {"fact_orders": stored, "dim_users": users, "dim_products": products, "dim_date": dates}, facts, path


@pytest.mark.parametrize("n", [0, 1, 7, 30, 500])
def test_newest_facts_equal_those_of_all_months(model, n):
    stored, facts, _ = model
    plain = {**stored, "fact_orders": facts.drop(MONTH)}
    want = [r.fact_id for r in starry.newest_facts(plain, n).orderBy(F.col("full_date").desc(), "fact_id").collect()]
    got = [r.fact_id for r in starry.newest_facts(stored, n).orderBy(F.col("full_date").desc(), "fact_id").collect()]
    assert got == want and len(got) == min(n, len(want))


def test_newest_facts_leave_earlier_months_unread(model):
    stored, _, path = model
    months = months_of(stored["fact_orders"])
    assert len(months) > 6 and months == sorted(months, reverse=True)
    for month in months[4:]:
        shutil.rmtree(f"{path}/{MONTH}={month}")
    assert starry.newest_facts(stored, 12).count() == 12


@pytest.mark.parametrize("n", [1, 5, 40, 1000])
def test_newest_lines_equal_a_full_join(spark, n, monkeypatch):
    """Few users are known, so the newest ``n`` orders do not hold ``n`` valid lines; the last bound makes all orders meet."""
    start = dt.datetime(2024, 1, 1)
    draw = random.Random(6)
    orders = [(i, draw.randrange(9), None if i % 50 == 0 else start + dt.timedelta(hours=draw.randrange(200))) for i in range(600)]
    lines = [(i, draw.randrange(650), draw.randrange(6)) for i in range(1500)]
    t = {
        "orders": spark.createDataFrame(orders, "id long, user_id long, order_date timestamp_ntz").selectExpr(
            "*", "'F' AS status", "1.0 AS total", "1.0 AS discounted_total"),
        "order_items": spark.createDataFrame(lines, "id long, order_id long, product_id long").selectExpr(
            "*", "1 AS quantity", "1.0 AS price", "1.0 AS total"),
        "users": spark.range(3), "products": spark.range(1, 5),
    }
    known = {i: when for i, user, when in orders if user < 3}
    valid = [(known[order] is not None, -((known[order] or start) - start).total_seconds(), order, item)
             for item, order, product in lines if order in known and 1 <= product < 5]
    want = [v[3] for v in sorted(valid)[:n]]
    for bound in (1 << 16, 100, 0):
        monkeypatch.setattr(relational, "BROADCAST_ORDERS", bound)
        rows = relational.newest_lines(t, n).orderBy(F.col("order_date").desc_nulls_first(), "order_id", "item_id")
        assert [r.item_id for r in rows.collect()] == want
