"""Data quality, the keyed cache, synthetic data and chunked reading."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from merchantry import schemas
from merchantry.operators import cache, generate
from merchantry.operators import quality as q
from merchantry.streaming import chunks


@pytest.fixture
def bad(spark):
    users = [(1, "a@b", "a", 30, None), (None, None, None, 0, 5), (3, "nope", "c", 120, 0), (4, "", "d", -1, 1), (5, "x@y", "e", None, 99)]
    return {
        "users": spark.createDataFrame(users, "id bigint, email string, username string, age int, address_id bigint"),
        "products": spark.createDataFrame(
            [(1, "t", Decimal(1), 1, Decimal(5), 1), (None, "", Decimal(-1), -1, Decimal("5.01"), 9), (2, None, None, 0, Decimal(0), None)],
            "id bigint, title string, price decimal(10,2), stock int, rating decimal(3,2), category_id bigint"),
        "orders": spark.createDataFrame([(1, 1, Decimal(0)), (2, 0, Decimal(-1)), (None, 8, None), (4, None, None)], "id bigint, user_id bigint, total decimal(10,2)"),
        "order_items": spark.createDataFrame(
            [(1, 1, 1, 0), (2, 9, 1, -1), (3, None, 7, None), (4, 0, 2, 1)], "id bigint, order_id bigint, product_id bigint, quantity int"),
        "addresses": spark.createDataFrame([(1, "c", None), (2, None, ""), (None, None, "s")], "id bigint, city string, state string"),
        "categories": spark.createDataFrame([(1,)], "id bigint"),
    }


def test_row_rules(bad):
    got = sorted((r.rule, r.record_key or "") for n, rules in q.row_rules().items() for r in q.check_rows(bad[n], n, rules).collect())
    assert got == sorted([
        ("users_id_missing", ""), ("users_email_missing", ""), ("users_username_missing", ""), ("users_email_format", "3"),
        ("users_age_range", "3"), ("users_age_range", "4"), ("products_id_missing", ""), ("products_title_missing", ""),
        ("products_title_missing", "2"), ("products_price_negative", ""), ("products_stock_negative", ""),
        ("products_rating_range", ""), ("orders_id_missing", ""), ("orders_user_id_missing", "4"), ("orders_total_negative", "2"),
        ("order_items_order_id_missing", "3"), ("order_items_quantity_missing", "3"), ("order_items_quantity_negative", "2"),
        ("addresses_id_missing", ""), ("addresses_place_missing", "2"),
    ])


def test_row_rules_read_a_table_once(bad):
    plan = q.check_rows(bad["users"], "users", q.user_rules())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "Exchange" not in plan


def test_foreign_keys_skip_null_and_zero(bad):
    found = q.validate(bad)
    keys = {(r.rule, r.record_key): r.message for r in found.collect() if r.rule.endswith("_fk")}
    assert keys == {
        ("orders_user_id_fk", None): "user_id 8 not found in users", ("order_items_order_id_fk", "2"): "order_id 9 not found in orders",
        ("order_items_product_id_fk", "3"): "product_id 7 not found in products",
        ("users_address_id_fk", None): "address_id 5 not found in addresses", ("users_address_id_fk", "5"): "address_id 99 not found in addresses",
        ("products_category_id_fk", None): "category_id 9 not found in categories",
    }
    counts = {r.foreign_key: r.orphans for r in q.orphan_counts(bad).collect()}
    assert counts == {"orders.user_id": 2, "products.category_id": 1}


def test_summary_and_samples(spark, bad):
    found = q.validate(bad)
    row = q.summary(found, bad).first()
    assert row.tables_checked == 6 and row.total_records == 20 and not row.passed and row.errors + row.warnings == found.count()
    only_warnings = spark.createDataFrame([("t", "r", "warning", str(i), "m") for i in range(9)], q.FINDING)
    assert q.summary(only_warnings, bad).first().passed
    mixed = only_warnings.unionByName(spark.createDataFrame([("t", "r", "error", str(i), "m") for i in range(9)], q.FINDING))
    assert {r.severity: r.n for r in q.samples(mixed).groupBy("severity").agg(F.count("*").alias("n")).collect()} == {"error": 5, "warning": 3}


def test_missing_and_empty_tables(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "there"))
    tables, found = q.open_tables(spark, {"there": str(tmp_path / "there"), "gone": str(tmp_path / "gone")})
    assert list(tables) == ["there"] and [(r.table_name, r.severity) for r in found.collect()] == [("gone", "error")]
    assert q.check_not_empty(tables["there"], "there").count() == 0
    assert q.check_not_empty(tables["there"].limit(0), "there").first().message == "File is empty"


def test_declared_constraints(spark):
    reviews = spark.createDataFrame([(1, 1, 0), (1, 2, 5), (2, 7, None), (3, None, 6)], "id bigint, product_id bigint, rating int")
    products = spark.createDataFrame([(1, "a"), (2, None)], "id bigint, title string")
    tables = {"reviews": schemas.conform_to(reviews, "normalized", "reviews"), "products": schemas.conform_to(products, "normalized", "products")}
    got = sorted((r.rule, r.record_key) for r in q.validate_declared("normalized", tables).collect())
    assert got == [("products_title_not_null", "2"), ("reviews_id_unique", "1"), ("reviews_product_id_fk", "2"),
                   ("reviews_rating_check", "1"), ("reviews_rating_check", "3")]


NOON = "2025-01-01 12:00:00"


def test_cache_entries(spark):
    df = spark.createDataFrame([(1, None, "a", None), (0, 7, "b", "x"), (None, None, "c", None), (0, 0, "d", None)], "id bigint, _id bigint, name string, note string")
    got = {r.key: r for r in cache.entries(df, "user", NOON).collect()}
    assert set(got) == {"user:1", "user:7"} and json.loads(got["user:1"].value) == {"id": 1, "_id": None, "name": "a", "note": None}
    assert got["user:1"].expires_at == dt.datetime(2025, 1, 1, 13) and tuple(cache.put_report(df, "user").first()) == ("user", 4, 2)


@pytest.mark.parametrize("entity, seconds", [("user", 3600), ("product", 86400), ("order", 1800), ("review", 3600)])
def test_cache_ttl(spark, entity, seconds):
    stored = cache.entries(spark.createDataFrame([(1,)], "id bigint"), entity, NOON)
    left = {r.key: r.ttl_seconds for r in cache.remaining_ttl(stored, "2025-01-01 12:00:01").collect()}
    assert left == {f"{entity}:1": seconds - 1}
    assert cache.remaining_ttl(stored, "2025-01-03 12:00:00").count() == 0
    at_end = (dt.datetime(2025, 1, 1, 12) + dt.timedelta(seconds=seconds)).isoformat(" ")
    assert cache.get(stored, f"{entity}:1", at_end).count() == 0


def test_cache_put_get_delete(spark, rows):
    first = cache.entries(spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string"), "user", NOON)
    again = cache.entries(spark.createDataFrame([(2, "B")], "id bigint, name string"), "user", NOON)
    stored = cache.put(first, again)
    assert rows(cache.parsed(stored, spark.createDataFrame([], "id bigint, name string").schema)) == [(1, "a"), (2, "B")]
    keys = spark.createDataFrame([("user:2",), ("user:9",)], "key string")
    assert rows(cache.existed(stored, keys, NOON)) == [("user:2", True), ("user:9", False)]
    assert rows(cache.delete(stored, keys), "key") == [("user:1",)]
    assert rows(cache.get_many(stored, keys, NOON), "key") == [("user:2",)]
    assert rows(cache.key_counts(stored, NOON)) == [("user", 2)]


def test_cache_batch_last_record_wins(spark):
    df = spark.createDataFrame([(1, "late", 9), (1, "early", 2), (1, "middle", 5)], "id bigint, name string, pos bigint")
    assert json.loads(cache.entries(df, "user", NOON, "pos").first().value) == {"id": 1, "name": "late"}


@pytest.fixture
def seeds(spark):
    make = lambda table, columns, data: schemas.conform_to(spark.createDataFrame(data, columns), "normalized", table)
    return {
        "users": make("users", "id bigint, username string, age int", [(5, "u5", 40), (9, None, None), (7, "u7", 0)]),
        "products": make("products", "id bigint, title string, price double, rating double", [(1, "A", 10.0, 4.0), (2, "B", None, None)]),
        "orders": make("orders", "id bigint, user_id bigint, total double, discounted_total double, order_date timestamp_ntz", [
            (1, 1, 100.0, 1.0, dt.datetime(2024, 1, 1)), (2, 1, None, 3.0, dt.datetime(2024, 1, 1))]),
    }


def test_generated_users(seeds):
    got = {r.id: r for r in generate.users(seeds["users"], 8).collect()}
    assert sorted(got) == list(range(10_000, 10_008))
    assert [got[10_000 + i].username for i in range(4)] == ["u5_10000", "u7_10001", "user_10002", "u5_10003"]
    assert 18 <= got[10_000].age <= 75 and got[10_001].age == 0 and got[10_002].age is None
    assert got[10_007].email == "test_user_10007@example.com"


def test_generated_products_and_orders(seeds, rows):
    products = {r.id: r for r in generate.products(seeds["products"], 5).collect()}
    assert products[10_002].title == "A v2" and products[10_000].sku == "SKU-010000" and products[10_001].price is None
    assert 8 <= products[10_000].price <= 12 and 3 <= products[10_000].rating <= 5 and products[10_001].rating is None
    orders = generate.orders(seeds["orders"], 40)
    for r in orders.collect():
        assert 10_000 <= r.user_id <= 10_040
        if r.id % 2 == 0:
            assert 90 <= r.total <= 110 and abs(r.discounted_total - r.total * Decimal("0.85")) <= Decimal("0.005")
        else:
            assert r.total is None and r.discounted_total == 3
    assert rows(orders) == rows(generate.orders(seeds["orders"].repartition(2), 40))


def test_simple_records(spark):
    got = generate.simple_records(spark, 500).collect()
    assert [r.id for r in got] == list(range(1, 501)) and {r.status for r in got} == {"active", "inactive", "pending"}
    assert {r.category for r in got} == set("ABCDE") and {r.is_active for r in got} == {True, False}
    assert {r.priority for r in got} == set(range(1, 11)) and all(10 <= r.value <= 1000 for r in got)


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_chunks(spark, tmp_path, rows, fmt):
    df = spark.range(30).selectExpr("id", "concat('n', id) AS name")
    df.repartition(3).write.format(fmt).options(**chunks.OPTIONS.get(fmt, {})).save(str(tmp_path / "in"))
    copied = chunks.copy_in_chunks(chunks.chunk_stream(spark, str(tmp_path / "in"), fmt, df.schema), str(tmp_path / "out"))
    assert rows(copied.drop("chunk")) == rows(df) and chunks.chunk_sizes(copied).count() == 3


@pytest.mark.parametrize("rows_in, files", [(150_000, 30), (3_000_000, 32)])
def test_files_of_a_stream_do_not_grow_in_number(spark, tmp_path, rows_in, files):
    """A micro-batch takes seconds: 20 times the rows make longer files, not 20 times the batches."""
    df = spark.range(rows_in).coalesce(1)
    df.write.option("maxRecordsPerFile", chunks.rows_per_file(rows_in, 5000)).json(str(tmp_path / "in"))
    assert len(list((tmp_path / "in").glob("*.json"))) == files


def test_chunks_resume_and_skip_bad_lines(spark, tmp_path):
    source, seen = tmp_path / "in", []
    source.mkdir()
    (source / "a.json").write_text('{"id": 1}\n\n{"id": \n{"id": 2}\n')
    schema = spark.range(1).schema
    handle = lambda rows, number: seen.append((number, sorted(r.id for r in rows.collect())))
    for name, text in (("b.json", '{"id": 3}\n'), (None, None)):
        chunks.for_each_chunk(chunks.chunk_stream(spark, str(source), "json", schema), handle, str(tmp_path / "checkpoint"))
        if name:
            (source / name).write_text(text)
    assert seen == [(0, [1, 2]), (1, [3])]


def test_keys_in_blocks(spark, rows):
    """The same orphans as by a join of the keys, at the borders of blocks, below zero and at both ends of the numbers."""
    ends = [-2**63, -65, -64, -1, 1, 63, 64, 127, 128, 2**40, 2**63 - 1]
    parents = spark.createDataFrame([(k,) for k in [*ends[::2], 1, None]], "id long")
    children = spark.createDataFrame(list(enumerate([*ends, *ends, 0, None, 2, 62])), "id long, ref long")
    known = q.key_blocks(parents, "id")
    got = q.orphans(children, parents, "ref", known=known)
    assert got.columns == ["id", "ref"] and got.count() == 12 and rows(got) == rows(q.orphans(children, parents, "ref"))
    few = spark.createDataFrame([(1, 128), (2, 129), (3, None)], "id long, ref int")
    assert rows(q.orphans(few, parents, "ref", known=known)) == rows(q.orphans(few, parents, "ref")) == [(2, 129)]


def test_declared_keys_shuffle_no_child(spark):
    """Parents whose keys do not fit a broadcast as a column do so in blocks: their children stay where they are."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, 64 << 10)
    try:
        users = spark.range(1, 30_001).selectExpr("id", "concat('u', id) AS username")
        orders = spark.range(1, 60_001).selectExpr("id", "id % 30001 + 1 AS user_id")
        tables = {n: schemas.conform_to(df, "normalized", n) for n, df in (("users", users), ("orders", orders))}
        found = q.validate_declared("normalized", tables).filter("rule = 'orders_user_id_fk'")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 1 and found.first().message == "user_id 30001 not found in users"
        assert "BroadcastHashJoin" in plan and "hashpartitioning(user_id" not in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set(setting, before)


def test_repeated_keys_in_crowded_blocks(spark, rows):
    """The same repeated keys as by a count of all keys; rows outside the crowded blocks are not counted by key."""
    keys = [-2**63, -2**63, -65, -64, -64, -1, 0, 63, 64, 64, 64, 2**63 - 1, None, None, *range(128, 256)]
    df = spark.createDataFrame([(k,) for k in keys], "id long")
    crowded = q.crowded_blocks(df, "id")
    assert rows(crowded) == [(-1,), (-2**57,), (1,)]
    got = rows(q.check_unique(df, "t", ["id"], crowded), "record_key", "message")
    assert got == rows(q.check_unique(df, "t", ["id"]), "record_key", "message") and len(got) == 3
    users = schemas.conform_to(spark.range(1, 1001).selectExpr("id", "concat('u', id) AS username"), "normalized", "users")
    twice = users.unionByName(users.filter("id = 7"))
    for df, want in ((users, []), (twice, [("users", "users_id_unique", "error", "7", "Key occurs 2 times")])):
        found = q.validate_declared("normalized", {"users": df}).filter("rule = 'users_id_unique'")
        assert rows(found) == want and "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()
