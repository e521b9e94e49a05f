"""Scaled-up synthetic tables: three copies of each source row; random values are checked by their ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from merchantry.operators import generate
from merchantry.plans import models
from merchantry.registry.base import answer, register
from merchantry.sources.store import scratch_path

COPIES = 3


def _source(spark, sf, name):
    return models.normalized(spark, sf)[name]


COPIED = "(SELECT s.*, rn + r * n AS new_id, r FROM (SELECT *, 9999 + row_number() OVER (ORDER BY id) AS rn, count(*) OVER () AS n FROM {0}) s, range(3) AS x(r))"


@register("gen_1_users", answer("id username email age_ok:b phone_ok:b ssn_ok:b role", f"""
    SELECT new_id AS id, username || '_' || new_id AS username, 'test_user_' || new_id || '@example.com' AS email, TRUE AS age_ok,
        TRUE AS phone_ok, TRUE AS ssn_ok, role FROM {COPIED.format("t_users")} AS c"""))
def _(spark, sf):
    source = _source(spark, sf, "users")
    made = generate.users(source, COPIES * source.count())
    return made.select(
        "id", "username", "email", F.col("age").between(18, 75).alias("age_ok"),
        F.col("phone").rlike(r"^\+1-555-\d{4}-\d{4}$").alias("phone_ok"),
        F.col("ssn").rlike(r"^\d{3}-\d{2}-\d{4}$").alias("ssn_ok"), "role",
    )


@register("gen_2_products", answer("id title sku price_ok:b stock_ok:b rating_ok:b barcode_ok:b", f"""
    SELECT new_id AS id, title || ' v' || (r + 1) AS title, 'SKU-' || lpad(CAST(new_id AS VARCHAR), 6, '0') AS sku, TRUE AS price_ok,
        TRUE AS stock_ok, TRUE AS rating_ok, TRUE AS barcode_ok FROM {COPIED.format("t_products")} AS c"""))
def _(spark, sf):
    source = _source(spark, sf, "products")
    made = generate.products(source, COPIES * source.count())
    bounds = source.agg((F.min("price") * 0.79).alias("low"), (F.max("price") * 1.21).alias("high"))
    return made.select(
        "id", "title", "sku", F.col("price").between(bounds.select("low").scalar(), bounds.select("high").scalar()).alias("price_ok"),
        F.col("stock").between(0, 500).alias("stock_ok"), F.col("rating").between(3, 5).alias("rating_ok"),
        F.col("barcode").rlike(r"^\d{13}$").alias("barcode_ok"),
    )


@register("gen_3_orders", answer("id status user_ok:b discounted_ok:b", f"""
    SELECT new_id AS id, status, TRUE AS user_ok, TRUE AS discounted_ok FROM {COPIED.format("t_orders")} AS c"""))
def _(spark, sf):
    source = _source(spark, sf, "orders")
    count = COPIES * source.count()
    made = generate.orders(source, count)
    return made.select(
        "id", "status", F.col("user_id").between(generate.FIRST_ID, generate.FIRST_ID + count).alias("user_ok"),
        (F.abs(F.col("discounted_total") - F.col("total") * F.lit(0.85)) < 0.006).alias("discounted_ok"),
    )


@register("gen_4_simple_records", answer("id name description value_ok:b status_ok:b category_ok:b priority_ok:b created_ok:b", """
    SELECT i AS id, 'Test Record ' || i AS name, 'This is test record number ' || i || ' for performance benchmarking' AS description,
        TRUE AS value_ok, TRUE AS status_ok, TRUE AS category_ok, TRUE AS priority_ok, TRUE AS created_ok
    FROM (SELECT unnest(range(1, (SELECT count(*) FROM orders) + 1)) AS i) AS x"""))
def _(spark, sf):
    """As many records as there are orders."""
    made = generate.simple_records(spark, _source(spark, sf, "orders").count())
    age = F.datediff(F.lit("2025-12-01").cast("date"), F.to_date("created_at"))
    return made.select(
        "id", "name", "description", F.col("value").between(10, 1000).alias("value_ok"),
        F.col("status").isin("active", "inactive", "pending").alias("status_ok"),
        F.col("category").isin(*"ABCDE").alias("category_ok"), F.col("priority").between(1, 10).alias("priority_ok"),
        age.between(0, 365).alias("created_ok"),
    )


@register("gen_5_all", answer("table_name row_count:i whole_lines:b", """
    SELECT unnest(['test_users', 'test_products', 'test_orders', 'test_records']) AS table_name, (SELECT count(*) FROM orders) AS row_count,
        TRUE AS whole_lines"""))
def _(spark, sf):
    """Four files with their rows and sizes; each size is that of the records as JSON and their line ends."""
    tables = models.normalized(spark, sf)
    count = tables["orders"].count()
    facts = generate.generate_files(tables, scratch_path(spark, "generated"), count)
    lines = None
    for name, df in generate.generate_all(tables, count).items():
        size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))) + 1).alias("want")).select(F.lit(name).alias("table_name"), "want")
        lines = size if lines is None else lines.unionByName(size)
    return facts.join(lines, "table_name").select("table_name", "row_count", (F.col("size_bytes") == F.col("want")).alias("whole_lines"))
