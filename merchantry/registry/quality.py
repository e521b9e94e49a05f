"""Data quality rules over flat tables with faults that follow from their values."""

from __future__ import annotations

from collections import ChainMap

from pyspark.sql import functions as F

from merchantry import schemas
from merchantry.operators import dimensions as d
from merchantry.operators import quality as q
from merchantry.plans import models
from merchantry.registry.base import CTES, answer, register

FINDING = "table_name rule severity record_key message"

# column -> SQL expression of its faulty version; the same text is used by both engines
FAULTS = {
    "users": {
        "id": "CASE WHEN age <> 81 THEN id END",
        "email": "CASE WHEN age = 85 THEN 'nobody' WHEN age = 84 THEN '' WHEN age <> 86 THEN email END",
        "username": "CASE WHEN age <> 83 THEN username END",
        "age": "CASE WHEN age = 80 THEN 0 WHEN age = 79 THEN 130 WHEN age = 78 THEN -4 ELSE age END",
    },
    "products": {
        "id": "CASE WHEN stock <> 6 THEN id END",
        "title": "CASE WHEN stock = 1 THEN '' WHEN stock <> 2 THEN title END",
        "price": "CASE WHEN stock = 3 THEN -price ELSE price END",
        "rating": "CASE WHEN stock = 5 THEN -rating ELSE rating END",
        "category_id": "CASE WHEN stock = 7 THEN 999 WHEN stock = 8 THEN 0 WHEN stock <> 9 THEN category_id END",
        "stock": "CASE WHEN stock = 4 THEN -stock ELSE stock END",
    },
    "orders": {
        "id": "CASE WHEN total_quantity <> 60 THEN id END",
        "user_id": "CASE WHEN total_quantity = 61 THEN 0 WHEN total_quantity <> 62 THEN user_id END",
        "total": "CASE WHEN total_quantity = 63 THEN -total ELSE total END",
    },
    "order_items": {
        "order_id": "CASE WHEN quantity <> 50 THEN order_id END",
        "product_id": "CASE WHEN quantity = 45 THEN -product_id WHEN quantity <> 49 THEN product_id END",
        "quantity": "CASE WHEN quantity = 48 THEN -quantity WHEN quantity = 47 THEN 0 WHEN quantity <> 46 THEN quantity END",
    },
    "addresses": {
        "id": "CASE WHEN state_code <> 'NM' THEN id END",
        "city": "CASE WHEN state_code = 'GU' THEN '' ELSE city END",
        "state": "CASE WHEN state_code <> 'GU' THEN state END",
    },
    "reviews": {"rating": "CASE WHEN rating = 5 THEN 6 WHEN rating = 4 THEN 0 WHEN rating <> 3 THEN rating END"},
}
# rows that are missing from the parent side
LOST = {"users": "age < 70", "addresses": "state_code <> 'PR'", "categories": "slug <> 'promo'", "products": "stock < 48",
        "orders": "total_quantity < 200"}
CTE_OF = {"users": "t_users", "products": "t_products", "orders": "t_orders", "order_items": "t_items",
          "addresses": "t_addresses", "reviews": "t_reviews", "categories": "t_categories"}

for _name, _faults in FAULTS.items():
    CTES[f"bad_{_name}"] = f"SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in _faults.items())}) FROM {CTE_OF[_name]}"
for _name, _condition in LOST.items():
    CTES[f"few_{_name}"] = f"SELECT * FROM {CTE_OF[_name]} WHERE {_condition}"


def faulty(spark, sf, name):
    df = models.normalized(spark, sf)[name]
    faults = FAULTS[name]
    return df.selectExpr(*[f"{faults[c]} AS {c}" if c in faults else c for c in df.columns])


def few(spark, sf, name):
    return models.normalized(spark, sf)[name].filter(LOST[name])


def finding_sql(table: str, rule: str, severity: str, where: str, message: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{severity}' AS severity, CAST(id AS VARCHAR) AS record_key, "
            f"{message} AS message FROM bad_{table} WHERE {where}")


RULES = {  # entry -> (table, [(rule, severity, condition, message)])
    "dq_3_users_required": ("users", [
        (f"users_{f}_missing", "error", f"{f} IS NULL", f"'Missing required field ''{f}'''") for f in ("id", "email", "username")]),
    "dq_4_users_email_format": ("users", [
        ("users_email_format", "warning", "email <> '' AND NOT contains(email, '@')", "'Invalid email format: ' || email")]),
    "dq_5_users_age_range": ("users", [
        ("users_age_range", "warning", "age <> 0 AND (age <= 0 OR age >= 120)", "'Suspicious age value: ' || CAST(age AS VARCHAR)")]),
    "dq_6_products_id": ("products", [("products_id_missing", "error", "id IS NULL", "'Missing ''id'''")]),
    "dq_7_products_title": ("products", [("products_title_missing", "error", "coalesce(title, '') = ''", "'Missing ''title'''")]),
    "dq_8_products_price": ("products", [
        ("products_price_negative", "error", "price < 0", "'Negative price: ' || CAST(price AS VARCHAR)")]),
    "dq_9_products_stock": ("products", [
        ("products_stock_negative", "warning", "stock < 0", "'Negative stock: ' || CAST(stock AS VARCHAR)")]),
    "dq_10_products_rating": ("products", [
        ("products_rating_range", "warning", "rating < 0 OR rating > 5", "'Rating out of range: ' || CAST(rating AS VARCHAR)")]),
    "dq_11_orders_keys": ("orders", [
        (f"orders_{f}_missing", "error", f"{f} IS NULL", f"'Missing ''{f}'''") for f in ("id", "user_id")]),
    "dq_12_orders_total": ("orders", [
        ("orders_total_negative", "error", "total < 0", "'Negative total: ' || CAST(total AS VARCHAR)")]),
    "dq_13_order_items_keys": ("order_items", [
        (f"order_items_{f}_missing", "error", f"{f} IS NULL", f"'Missing ''{f}'''") for f in ("order_id", "product_id", "quantity")]),
    "dq_14_order_items_quantity": ("order_items", [
        ("order_items_quantity_negative", "error", "quantity < 0", "'Invalid quantity: ' || CAST(quantity AS VARCHAR)")]),
    "dq_15_addresses_id": ("addresses", [("addresses_id_missing", "error", "id IS NULL", "'Missing ''id'''")]),
    "dq_16_addresses_place": ("addresses", [
        ("addresses_place_missing", "warning", "coalesce(city, '') = '' AND coalesce(state, '') = ''", "'Missing both city and state'")]),
}


def _row_rule_entry(entry: str, table: str, rules: list) -> None:
    names = {r[0] for r in rules}
    sql = answer(FINDING, " UNION ALL ".join(finding_sql(table, *r) for r in rules))

    @register(entry, sql)
    def _(spark, sf):
        chosen = [r for r in q.row_rules()[table] if r.name in names]
        return q.check_rows(faulty(spark, sf, table), table, chosen)


for _entry, (_table, _rules) in RULES.items():
    _row_rule_entry(_entry, _table, _rules)

ALL_ROW_FINDINGS = " UNION ALL ".join(finding_sql(table, *r) for table, rules in RULES.values() for r in rules)

KEYS = {
    "dq_17_orders_users_fk": ("orders", "user_id", "users"), "dq_18_items_orders_fk": ("order_items", "order_id", "orders"),
    "dq_19_items_products_fk": ("order_items", "product_id", "products"),
    "dq_20_users_addresses_fk": ("users", "address_id", "addresses"),
    "dq_21_products_categories_fk": ("products", "category_id", "categories"),
}


def fk_sql(child: str, column: str, parent: str) -> str:
    return (f"SELECT '{child}' AS table_name, '{child}_{column}_fk' AS rule, 'error' AS severity, CAST(id AS VARCHAR) AS record_key, "
            f"'{column} ' || CAST({column} AS VARCHAR) || ' not found in {parent}' AS message FROM bad_{child} "
            f"WHERE {column} <> 0 AND {column} NOT IN (SELECT id FROM few_{parent})")


def _key_entry(entry: str, child: str, column: str, parent: str) -> None:
    @register(entry, answer(FINDING, fk_sql(child, column, parent)))
    def _(spark, sf):
        fk = next(k for k in schemas.FOREIGN_KEYS["normalized"] if (k.child, k.column) == (child, column))
        return q.check_foreign_key({child: faulty(spark, sf, child), parent: few(spark, sf, parent)}, fk)


for _entry, _key in KEYS.items():
    _key_entry(_entry, *_key)


@register("dq_1_unreadable_tables", answer(FINDING + " readable:i", """
    SELECT 'returns' AS table_name, 'returns_readable' AS rule, 'error' AS severity, NULL AS record_key,
        'File not found: returns.parquet' AS message, (SELECT count(*) FROM part) + (SELECT count(*) FROM orders) AS readable"""))
def _(spark, sf):
    """One of three tables asked for does not exist; the others are read in full."""
    paths = {name: f"{sf}/{name}.parquet" for name in ("part", "orders", "returns")}
    tables, findings = q.open_tables(spark, paths)
    readable = d.row_counts(tables).agg(F.sum("row_count").alias("n")).scalar()
    # the folder differs from run to run
    message = F.regexp_replace("message", r": .*/", ": ")
    return findings.withColumn("message", message).withColumn("readable", readable)


@register("dq_2_empty_tables", answer(FINDING, """
    SELECT 'no_refunds' AS table_name, 'no_refunds_empty' AS rule, 'warning' AS severity, NULL AS record_key, 'File is empty' AS message
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_totalprice < 0)"""))
def _(spark, sf):
    orders = models.normalized(spark, sf)["orders"]
    return q.check_not_empty(orders, "orders").unionByName(q.check_not_empty(orders.filter("total < 0"), "no_refunds"))


def _not_null_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{table}_{c}_not_null' AS rule, 'error' AS severity, CAST(id AS VARCHAR) AS record_key, "
        f"'Null in column ''{c}''' AS message FROM bad_{table} WHERE {c} IS NULL" for c in columns)


@register("dq_22_not_null", answer(FINDING, _not_null_sql("products", ["id", "title"]) + " UNION ALL " + _not_null_sql("order_items", ["quantity"])))
def _(spark, sf):
    return q.union_all([
        q.check_rows(faulty(spark, sf, n), n, q.not_null_rules("normalized", n)) for n in ("products", "order_items")
    ])


@register("dq_23_unique", answer(FINDING, """
    SELECT 'addresses' AS table_name, 'addresses_city_state_code_unique' AS rule, 'error' AS severity,
        city || '|' || state_code AS record_key, 'Key occurs ' || CAST(count(*) AS VARCHAR) || ' times' AS message
    FROM t_addresses GROUP BY city, state_code HAVING count(*) > 1"""))
def _(spark, sf):
    return q.check_unique(models.normalized(spark, sf)["addresses"], "addresses", ["city", "state_code"])


@register("dq_24_review_rating", answer(FINDING, """
    SELECT 'reviews' AS table_name, 'reviews_rating_check' AS rule, 'error' AS severity, CAST(id AS VARCHAR) AS record_key,
        'Rating out of range: ' || CAST(rating AS VARCHAR) AS message FROM bad_reviews WHERE rating < 1 OR rating > 5"""))
def _(spark, sf):
    return q.check_rows(faulty(spark, sf, "reviews"), "reviews", [q.review_rating_rule()])


DECLARED_SQL = " UNION ALL ".join([
    _not_null_sql("products", ["id", "title"]), _not_null_sql("users", ["id"]), _not_null_sql("orders", ["id"]),
    _not_null_sql("addresses", ["id"]),
    *[f"""SELECT '{table}' AS table_name, '{table}_id_unique' AS rule, 'error' AS severity, CAST(id AS VARCHAR) AS record_key,
        'Key occurs ' || CAST(count(*) AS VARCHAR) || ' times' AS message FROM bad_{table} WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1"""
      for table in ("products", "users", "orders", "addresses")],
])


@register("dq_25_declared_constraints", answer(FINDING, DECLARED_SQL))
def _(spark, sf):
    """Declared NOT NULL and unique keys of faulty tables; the built models add no finding of theirs."""
    bad = {n: faulty(spark, sf, n) for n in ("products", "users", "orders", "addresses")}
    keys = q.union_all([
        f for n, df in bad.items()
        for f in (q.check_rows(df, n, q.not_null_rules("normalized", n)), q.check_unique(df, n, ["id"]))
    ])
    return q.union_all([
        keys,
        q.validate_declared("star", models.declared("star", models.star(spark, sf))),
        q.validate_declared("snowflake", models.declared("snowflake", models.snowflake(spark, sf))),
        q.validate_declared("normalized", models.normalized(spark, sf)),
    ])


@register("dq_25_fact_keys", answer(FINDING, """
    SELECT 'fact_orders' AS table_name, 'fact_orders_product_id_fk' AS rule, 'error' AS severity, CAST(fact_id AS VARCHAR) AS record_key,
        'product_id ' || CAST(product_id AS VARCHAR) || ' not found in dim_products' AS message
    FROM t_fact WHERE product_id <> 0 AND product_id NOT IN (SELECT id FROM few_products)"""))
def _(spark, sf):
    whole = models.star(spark, sf)
    built = ChainMap({"dim_products": whole["dim_products"].filter(LOST["products"])}, whole)
    fk = next(k for k in schemas.FOREIGN_KEYS["star"] if k.column == "product_id")
    return q.check_foreign_key(built, fk, "fact_id")


@register("dq_26_orphan_counts", answer("foreign_key orphans:i", """
    SELECT 'orders.user_id' AS foreign_key, count(*) AS orphans FROM t_orders o LEFT JOIN few_users u ON o.user_id = u.id
    WHERE o.user_id IS NOT NULL AND u.id IS NULL
    UNION ALL SELECT 'products.category_id', count(*) FROM t_products p LEFT JOIN few_categories c ON p.category_id = c.id
    WHERE p.category_id IS NOT NULL AND c.id IS NULL"""))
def _(spark, sf):
    tables = ChainMap({n: few(spark, sf, n) for n in ("users", "categories")}, models.normalized(spark, sf))
    return q.orphan_counts(tables)


COUNTED = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {c}" for n, c in [
    ("users", "t_users"), ("products", "t_products"), ("orders", "t_orders"), ("order_items", "t_items"),
    ("addresses", "t_addresses"), ("categories", "t_categories"), ("banks", "t_banks"), ("companies", "t_companies")])


@register("dq_27_row_counts", answer("table_name row_count:i", f"""
    {COUNTED} UNION ALL SELECT 'total', sum(row_count) FROM ({COUNTED}) AS c"""))
def _(spark, sf):
    return q.counted_rows(models.normalized(spark, sf))


def _all_findings(spark, sf):
    return q.union_all([
        q.check_rows(faulty(spark, sf, n), n, rules) for n, rules in q.row_rules().items()
    ])


@register("dq_28_summary", answer("tables_checked:i total_records:i errors:i warnings:i passed", f"""
    SELECT 5 AS tables_checked, (SELECT sum(n) FROM (SELECT count(*) AS n FROM t_users UNION ALL SELECT count(*) FROM t_products
        UNION ALL SELECT count(*) FROM t_orders UNION ALL SELECT count(*) FROM t_items UNION ALL SELECT count(*) FROM t_addresses) AS c)
        AS total_records, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings,
        count(*) FILTER (severity = 'error') = 0 AS passed
    FROM ({ALL_ROW_FINDINGS}) AS f"""))
def _(spark, sf):
    tables = {n: faulty(spark, sf, n) for n in q.row_rules()}
    return q.summary(_all_findings(spark, sf), tables)


@register("dq_28_counts_by_table", answer("table_name severity findings:i", f"""
    SELECT table_name, severity, count(*) AS findings FROM ({ALL_ROW_FINDINGS}) AS f GROUP BY table_name, severity"""))
def _(spark, sf):
    return q.counts_by_table(_all_findings(spark, sf))


@register("dq_28_samples", answer(FINDING, f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_name, severity ORDER BY record_key NULLS FIRST, rule, message) AS n
        FROM ({ALL_ROW_FINDINGS}) AS f) AS r WHERE n <= CASE severity WHEN 'error' THEN 5 ELSE 3 END"""))
def _(spark, sf):
    return q.samples(_all_findings(spark, sf))
