"""Filters, aggregates, joins, windows, sorts, set operations and scalar functions."""

from __future__ import annotations

from collections import ChainMap

from pyspark.sql import Window
from pyspark.sql import functions as F

from merchantry.functions.money import mean_money, percent_of
from merchantry.functions.text import concat_skip_nulls, display_name, slug
from merchantry.operators import bitmaps, hierarchy, normalize, records
from merchantry.plans import models, snowy
from merchantry.plans.common import best
from merchantry.registry.base import answer, mean, percent, register
from merchantry.sources import retail


def t(spark, sf):
    return models.normalized(spark, sf)


def table(spark, sf, name):
    return retail.table(spark, sf, name)


@register("prj_1_filter", answer(
    "l_orderkey l_partkey l_quantity l_extendedprice", "SELECT * FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'"))
def _(spark, sf):
    rows = records.filter_rows(table(spark, sf, "lineitem"), "l_quantity > 45 AND l_returnflag = 'R'")
    return rows.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")


@register("udf_1_filter_by_function", answer(
    "c_custkey c_name c_acctbal", "SELECT * FROM customer WHERE c_acctbal > 500 AND c_mktsegment = 'BUILDING'"))
def _(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    kept = records.filter_by_function(customers, lambda r: r["c_acctbal"] > 500 and r["c_mktsegment"] == "BUILDING")
    return kept.drop("c_mktsegment")


@register("prj_2_flat_products", answer(
    "id title description category price:d discountPercentage:d rating:d stock:i brand sku weight:d thumbnail", """
    SELECT p.id, p.title, p.description, CASE WHEN p_size < 25 THEN p_type WHEN p_size < 50 THEN lower(p_type) END AS category,
        p.price, discount_percentage AS "discountPercentage", p.rating, p.stock, p.brand, p.sku, p.weight, thumbnail_url AS thumbnail
    FROM t_products p"""))
def _(spark, sf):
    return records.flat_products(retail.raw_products(spark, sf))


@register("prj_3_flat_users", answer(
    'id "firstName" "lastName" age:i gender email phone username "birthDate" address_city address_street address_state "address_postalCode"', """
    SELECT u.id, first_name AS "firstName", last_name AS "lastName", age, gender, email, phone, username,
        strftime(birth_date, '%Y-%m-%d') AS "birthDate", a.city AS address_city, a.address_line AS address_street,
        a.state AS address_state, a.postal_code AS "address_postalCode"
    FROM t_users u LEFT JOIN t_addresses a ON u.address_id = a.id"""))
def _(spark, sf):
    return records.flat_users(retail.raw_users(spark, sf)).drop("maidenName", "password", "image")


@register("prj_4_snake_case", answer(
    "id first_name last_name email birth_date hair_color crypto_coin crypto_wallet", """
    SELECT id, first_name, last_name, email, strftime(birth_date, '%Y-%m-%d') AS birth_date, hair_color, crypto_coin, crypto_wallet
    FROM t_users"""))
def _(spark, sf):
    return retail.raw_users(spark, sf).select(*normalize.renamed(normalize.USER_FIELDS)).select(
        "id", "first_name", "last_name", "email", "birth_date", "hair_color", "crypto_coin", "crypto_wallet"
    )


@register("prj_5_range_conjunction", answer("id title price:d stock:i category_name", """
    SELECT p.id, p.title, p.price, p.stock, c.name AS category_name FROM t_products p JOIN t_categories c ON p.category_id = c.id
    WHERE p.price > 50 AND p.stock > 10"""))
def _(spark, sf):
    tables = t(spark, sf)
    names = tables["categories"].select(F.col("id").alias("category_id"), F.col("name").alias("category_name"))
    return tables["products"].filter("price > 50 AND stock > 10").join(names, "category_id").select(
        "id", "title", "price", "stock", "category_name"
    )


@register("prj_6_document_filter", answer("_id title slug", """
    SELECT p.id AS _id, p.title, c.slug FROM t_products p JOIN t_categories c ON p.category_id = c.id
    WHERE p.price > 50 AND p.stock > 10"""))
def _(spark, sf):
    docs = models.collections(spark, sf)["products"]
    return docs.filter("price > 50 AND stock > 10").select("_id", "title", F.col("category.slug").alias("slug"))


@register("prj_7_date_between", answer(
    "o_orderkey day:day", "SELECT o_orderkey, o_orderdate AS day FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31'"))
def _(spark, sf):
    bounds = [F.lit(b).cast("timestamp_ntz") for b in ("1998-01-01", "1998-12-31")]
    return table(spark, sf, "orders").filter(F.col("o_orderdate").between(*bounds)).select(
        "o_orderkey", F.to_date("o_orderdate").alias("day")
    )


@register("prj_8_not_null", answer("id brand", "SELECT id, brand FROM t_products WHERE brand IS NOT NULL"))
def _(spark, sf):
    return t(spark, sf)["products"].filter(F.col("brand").isNotNull()).select("id", "brand")


@register("prj_9_lookup_by_id", answer("id username email", "SELECT id, username, email FROM t_users WHERE id = 42"))
def _(spark, sf):
    return records.by_ids(t(spark, sf)["users"], [42]).select("id", "username", "email")


@register("prj_9_lookup_many", answer("id username", """
    SELECT id, username FROM t_users WHERE id IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')"""))
def _(spark, sf):
    wanted = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id"))
    return records.by_ids(t(spark, sf)["users"], wanted).select("id", "username")


@register("prj_10_null_keys_skipped", answer(
    "brand products:i", "SELECT brand, count(*) AS products FROM t_products WHERE brand IS NOT NULL GROUP BY brand"))
def _(spark, sf):
    return t(spark, sf)["products"].filter(F.col("brand").isNotNull()).groupBy("brand").agg(F.count("*").alias("products"))


@register("prj_11_falsy_ids_skipped", answer(
    "cache_id:i c_name", "SELECT c_custkey AS cache_id, c_name FROM customer WHERE c_custkey <> 0"))
def _(spark, sf):
    from merchantry.operators.cache import record_id
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.lit(None).cast("bigint").alias("_id"), "c_name")
    return rows.select(record_id(rows).alias("cache_id"), "c_name").filter("cache_id IS NOT NULL")


AGGREGATES_SQL = " UNION ALL ".join(
    f"SELECT '{op}' AS operation, coalesce({sql}, 0) AS value FROM t_items" for op, sql in [
        ("sum", "CAST(sum(quantity) AS DOUBLE)"), ("count", "CAST(count(quantity) AS DOUBLE)"),
        ("min", "CAST(min(quantity) AS DOUBLE)"), ("max", "CAST(max(quantity) AS DOUBLE)"), ("avg", "avg(quantity)"),
    ]) + " UNION ALL SELECT 'sum of none', 0.0"


@register("agg_1_single_column", answer("operation value:d", AGGREGATES_SQL))
def _(spark, sf):
    """All operations over one column in one scan, and a sum over no rows."""
    items = t(spark, sf)["order_items"].select("quantity")
    values = records.aggregate_all(items, "quantity")
    out = values.select(F.posexplode(F.array(*[F.struct(F.lit(op).alias("operation"), F.col(op).cast("double").alias("value"))
                                               for op in records.AGGREGATES])).alias("_at", "r")).select("r.*")
    none = records.aggregate(items.filter("quantity < 0"), "quantity", "sum")
    return out.unionByName(none.select(F.lit("sum of none").alias("operation"), F.col("value").cast("double")))


@register("agg_2_several_distinct_counts", answer("l_returnflag orders:i parts:i suppliers:i", """
    SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts,
        count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_returnflag"""))
def _(spark, sf):
    """Each distinct count is an aggregate of its own, so no line is copied."""
    lines, out = table(spark, sf, "lineitem"), None
    for name, column in (("orders", "l_orderkey"), ("parts", "l_partkey"), ("suppliers", "l_suppkey")):
        counts = lines.groupBy("l_returnflag").agg(F.count_distinct(column).alias(name))
        out = counts if out is None else out.join(counts, "l_returnflag")
    return out


@register("agg_3_group_measures", answer("status n:i total:d smallest:d largest:d average:d", f"""
    SELECT status, count(*) AS n, sum(total) AS total, min(total) AS smallest, max(total) AS largest,
        {mean("sum(total)", "count(total)")} AS average FROM t_orders GROUP BY status"""))
def _(spark, sf):
    return t(spark, sf)["orders"].groupBy("status").agg(
        F.count("*").alias("n"), F.sum("total").alias("total"), F.min("total").alias("smallest"), F.max("total").alias("largest"),
        F.count("total").alias("_n"),
    ).withColumn("average", mean_money("total", "_n")).drop("_n")


@register("agg_5_group_by_day", answer("day:day n:i", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY CAST(ts AS DATE)"))
def _(spark, sf):
    return table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))


@register("agg_6_guarded_ratio", answer("product_id per_unit:d", f"""
    SELECT product_id, {mean("sum(total)", "sum(quantity)")} AS per_unit FROM t_items GROUP BY product_id"""))
def _(spark, sf):
    sums = t(spark, sf)["order_items"].groupBy("product_id").agg(F.sum("total").alias("_t"), F.sum("quantity").alias("_q"))
    return sums.select("product_id", mean_money("_t", "_q").alias("per_unit"))


@register("agg_7_share_of_total", answer("status share:d", f"""
    SELECT status, {percent("sum(total)", "sum(sum(total)) OVER ()")} AS share FROM t_orders GROUP BY status"""))
def _(spark, sf):
    per_status = t(spark, sf)["orders"].groupBy("status").agg(F.sum("total").alias("_t"))
    whole = per_status.agg(F.sum("_t").alias("w")).scalar()
    return per_status.withColumn("_w", whole).select("status", percent_of("_t", "_w").alias("share"))


@register("agg_8_rows_to_arrays", answer("order_id products", """
    SELECT o.id AS order_id, coalesce(string_agg(CAST(i.product_id AS VARCHAR), '|' ORDER BY i.id), '') AS products
    FROM t_orders o LEFT JOIN t_items i ON o.id = i.order_id GROUP BY o.id"""))
def _(spark, sf):
    from merchantry.operators.documents import Children, embed
    tables = t(spark, sf)
    heads = tables["orders"].select(F.col("id").alias("order_id"))
    lists = {"products": Children(tables["order_items"].select("id", "order_id", "product_id"), "order_id", ["id"], "product_id")}
    return embed(heads, "order_id", lists).withColumn(
        "products", F.array_join(F.transform("products", lambda p: p.cast("string")), "|")
    )


@register("agg_9_distinct_sets", answer("kind value", """
    SELECT DISTINCT 'role' AS kind, role AS value FROM t_users UNION ALL SELECT DISTINCT 'brand', brand FROM t_products WHERE brand <> ''
    UNION ALL SELECT DISTINCT 'state', state_code FROM t_addresses UNION ALL SELECT DISTINCT 'city', city FROM t_addresses"""))
def _(spark, sf):
    tables = t(spark, sf)
    sets = [("role", "users", "role"), ("brand", "products", "brand"), ("state", "addresses", "state_code"), ("city", "addresses", "city")]
    out = None
    for kind, name, column in sets:
        values = tables[name].filter(F.col(column) != "").select(F.lit(kind).alias("kind"), F.col(column).alias("value")).distinct()
        out = values if out is None else out.unionByName(values)
    return out


@register("agg_11_region_state_city_levels", answer("level place users:i", """
    SELECT 'region' AS level, region AS place, count(*) AS users FROM t_snowusers u JOIN t_geo g ON u.city_id = g.city_id GROUP BY region
    UNION ALL SELECT 'state', state_code, count(*) FROM t_snowusers u JOIN t_geo g ON u.city_id = g.city_id GROUP BY state_code
    UNION ALL SELECT 'city', city_name, count(*) FROM t_snowusers u JOIN t_geo g ON u.city_id = g.city_id GROUP BY city_name"""))
def _(spark, sf):
    m = models.snowflake(spark, sf)
    per_city = m["dim_users"].groupBy("city_id").agg(F.count("*").alias("_n")).join(snowy.cities_with_state(m), "city_id")
    out = None
    for level, column in (("region", "region"), ("state", "state_code"), ("city", "city_name")):
        rows = per_city.groupBy(F.col(column).alias("place")).agg(F.sum("_n").alias("users")).withColumn("level", F.lit(level))
        out = rows if out is None else out.unionByName(rows)
    return out


CUSTOMER_LEVELS = {
    "month": ["month_id"], "state": ["region", "state"], "region": ["region"], "region and month": ["region", "month_id"], "all": [],
}


@register("agg_2_customers_by_level", answer("level month_id:i region state customers:i", """
    WITH sold AS (SELECT year(o.order_date) * 100 + month(o.order_date) AS month_id, l.region, l.state, o.user_id FROM t_orders o
        JOIN (SELECT DISTINCT order_id FROM t_items) AS i ON o.id = i.order_id LEFT JOIN t_places p ON o.user_id = p.user_id
        LEFT JOIN t_locations l ON p.location_id = l.location_id)
    """ + " UNION ALL ".join(
    f"SELECT '{level}' AS level, " + ", ".join(
        f"{c if c in keys else 'NULL'} AS {c}" for c in ("month_id", "region", "state")
    ) + ", count(DISTINCT user_id) AS customers FROM sold" + (f" GROUP BY {', '.join(keys)}" if keys else "")
    for level, keys in CUSTOMER_LEVELS.items())))
def _(spark, sf):
    """Distinct customers per month, place and both, merged from one stored table of bitmaps."""
    sets = models.customer_sets(spark, sf)["customers"]
    out = None
    for level, keys in CUSTOMER_LEVELS.items():
        rest = [F.lit(None).cast(sets.schema[c].dataType).alias(c) for c in ("month_id", "region", "state") if c not in keys]
        rows = bitmaps.counted(sets, "customers", *keys).select(F.lit(level).alias("level"), *keys, *rest, "customers")
        out = rows if out is None else out.unionByName(rows)
    return out


@register("join_1_inner", answer("id category", "SELECT p.id, c.name AS category FROM t_products p JOIN t_categories c ON p.category_id = c.id"))
def _(spark, sf):
    tables = t(spark, sf)
    return tables["products"].alias("p").join(tables["categories"].alias("c"), F.col("p.category_id") == F.col("c.id")).select(
        "p.id", F.col("c.name").alias("category")
    )


@register("join_2_left", answer("id city", "SELECT u.id, a.city FROM t_users u LEFT JOIN t_addresses a ON u.address_id = a.id"))
def _(spark, sf):
    tables = t(spark, sf)
    return tables["users"].alias("u").join(tables["addresses"].alias("a"), F.col("u.address_id") == F.col("a.id"), "left").select(
        "u.id", "a.city"
    )


@register("join_4_hierarchy", answer("category_id:i category_name parent_category:s", """
    SELECT c.id AS category_id, c.name AS category_name, p.name AS parent_category FROM t_categories c
    LEFT JOIN t_categories p ON p.id = CASE WHEN c.id > 2 THEN c.id // 2 END"""))
def _(spark, sf):
    """The categories as a tree: each but the first two below the one with half its id."""
    m = models.snowflake(spark, sf)
    tree = m["dim_categories"].withColumn("parent_category_id", F.expr("CASE WHEN category_id > 2 THEN category_id DIV 2 END"))
    return snowy.categories_with_parent(ChainMap({"dim_categories": tree}, m)).drop("category_slug")


# the categories as a chain, each below the one before; 6 and 7 name each other
TREE_SQL = "SELECT id, name, CASE WHEN id = 6 THEN 7 WHEN id > 1 THEN id - 1 END AS parent_id FROM t_categories"
ROOTS_SQL = f"""
    WITH RECURSIVE tree AS ({TREE_SQL}), found AS (
        SELECT id, id AS root, 0 AS depth FROM tree WHERE parent_id IS NULL OR parent_id NOT IN (SELECT id FROM tree)
        UNION ALL SELECT tree.id, found.root, found.depth + 1 FROM tree JOIN found ON tree.parent_id = found.id)
    SELECT tree.id AS category_id, tree.name AS category_name, root, depth, root IS NULL AS in_cycle
    FROM tree LEFT JOIN found ON tree.id = found.id"""


def _category_roots(m):
    tree = m["dim_categories"].withColumn(
        "parent_category_id", F.expr("CASE WHEN category_id = 6 THEN 7 WHEN category_id > 1 THEN category_id - 1 END")
    )
    return hierarchy.roots(tree, "category_id", "parent_category_id")


@register("join_4_category_roots", answer("category_id:i category_name root:i depth:i in_cycle:b", ROOTS_SQL))
def _(spark, sf):
    """Root and depth of every category of a tree of any depth that holds a cycle."""
    m = models.snowflake(spark, sf)
    return _category_roots(m).join(m["dim_categories"].select("category_id", "category_name"), "category_id")


@register("join_4_sales_by_root", answer("root:i categories:i depth:i total_revenue:d", f"""
    SELECT root, count(*) AS categories, max(depth) AS depth, sum(revenue) AS total_revenue FROM ({ROOTS_SQL}) AS r LEFT JOIN (
        SELECT p.category_id AS sold_id, sum(f.total_amount) AS revenue FROM t_fact f JOIN t_products p ON f.product_id = p.id
        GROUP BY p.category_id) AS s ON r.category_id = s.sold_id GROUP BY root"""))
def _(spark, sf):
    """Sales of whole category trees; what has no root shares a row."""
    m = models.snowflake(spark, sf)
    sold = m["fact_orders"].groupBy("product_id").agg(F.sum("total_amount").alias("revenue")).join(
        m["dim_products"].select("product_id", "category_id"), "product_id"
    ).groupBy("category_id").agg(F.sum("revenue").alias("revenue"))
    return _category_roots(m).join(sold, "category_id", "left").groupBy("root").agg(
        F.count("*").alias("categories"), F.max("depth").alias("depth"), F.sum("revenue").alias("total_revenue")
    )


@register("join_5_semi", answer("id total:d", """
    SELECT id, total FROM t_orders WHERE id IN (SELECT order_id FROM t_items WHERE discount_percentage = 10)"""))
def _(spark, sf):
    tables = t(spark, sf)
    discounted = tables["order_items"].filter("discount_percentage = 10").select(F.col("order_id").alias("id"))
    return tables["orders"].join(discounted, "id", "left_semi").select("id", "total")


@register("join_6_anti", answer("id", "SELECT o.id FROM t_orders o LEFT JOIN t_items i ON o.id = i.order_id WHERE i.id IS NULL"))
def _(spark, sf):
    tables = t(spark, sf)
    return tables["orders"].join(tables["order_items"].select(F.col("order_id").alias("id")), "id", "left_anti").select("id")


@register("join_8_three_columns", answer("address_id:i first_id:i", """
    SELECT a.id AS address_id, f.first_id FROM t_addresses a JOIN (
        SELECT city, state_code, postal_code, min(id) AS first_id FROM t_addresses GROUP BY ALL) f
    ON a.city = f.city AND a.state_code = f.state_code AND a.postal_code = f.postal_code"""))
def _(spark, sf):
    addresses = t(spark, sf)["addresses"]
    place = ["city", "state_code", "postal_code"]
    firsts = addresses.groupBy(*place).agg(F.min("id").alias("first_id"))
    return addresses.join(firsts, place).select(F.col("id").alias("address_id"), "first_id")


@register("join_9_two_roles", answer("id home work", """
    SELECT u.id, a.address_line AS home, ca.address_line AS work FROM t_users u LEFT JOIN t_addresses a ON u.address_id = a.id
    LEFT JOIN t_companies c ON u.company_id = c.id LEFT JOIN t_addresses ca ON c.address_id = ca.id"""))
def _(spark, sf):
    from merchantry.operators.documents import user_documents
    return user_documents(t(spark, sf)).select(
        F.col("_id").alias("id"), F.col("address.address_line").alias("home"), F.col("company.address.address_line").alias("work")
    )


@register("join_10_fan_out", answer("user_id counted:d", """
    SELECT o.user_id, sum(o.total) AS counted FROM t_orders o JOIN t_items i ON o.id = i.order_id GROUP BY o.user_id"""))
def _(spark, sf):
    tables = t(spark, sf)
    lines = tables["order_items"].groupBy("order_id").agg(F.count("*").alias("_n"))
    joined = tables["orders"].join(lines, F.col("id") == F.col("order_id"))
    return joined.groupBy("user_id").agg(F.sum(F.col("total") * F.col("_n")).alias("counted"))


@register("win_1_lag", answer("month revenue:d previous:d growth:d", f"""
    SELECT *, {percent("revenue - previous", "previous")} AS growth FROM (
        SELECT *, lag(revenue) OVER (ORDER BY month) AS previous FROM (
            SELECT strftime(order_date, '%Y-%m') AS month, sum(total) AS revenue FROM t_orders GROUP BY 1) AS m) AS g"""))
def _(spark, sf):
    monthly = t(spark, sf)["orders"].groupBy(F.date_format("order_date", "yyyy-MM").alias("month")).agg(F.sum("total").alias("revenue"))
    # one row per calendar month by now
    with_previous = monthly.withColumn("previous", F.lag("revenue").over(Window.orderBy("month")))
    return with_previous.withColumn("growth", percent_of(F.col("revenue") - F.col("previous"), "previous"))


@register("win_4_top_per_group", answer("type brand", """
    SELECT p_type AS type, p_brand AS brand FROM (
        SELECT p_type, p_brand, row_number() OVER (PARTITION BY p_type ORDER BY sum(CAST(p_retailprice AS DECIMAL(12,2))) DESC, p_brand) AS rn
        FROM part GROUP BY p_type, p_brand) AS r WHERE rn = 1"""))
def _(spark, sf):
    sums = table(spark, sf, "part").groupBy("p_type", "p_brand").agg(F.sum(F.col("p_retailprice").cast("decimal(12,2)")).alias("s"))
    return best("p_type", "p_brand", "s", sums, "brand").withColumnRenamed("p_type", "type")


@register("win_5_first_per_group", answer("user_id event_id", """
    SELECT user_id, event_id FROM (
        SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) AS r WHERE rn <= 5"""))
def _(spark, sf):
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, sf, "events").select("user_id", "event_id", "ts").withColumn("rn", rank).filter("rn <= 5").select("user_id", "event_id")


@register("srt_1_stable_sort", answer("event_id value:d", "SELECT event_id, value FROM events"))
def _(spark, sf):
    return records.sort_rows(table(spark, sf, "events").select("event_id", "value"), "value", True, "event_id")


@register("srt_2_top_k", answer("id total:d", "SELECT id, total FROM t_orders ORDER BY total DESC NULLS FIRST, id LIMIT 25"))
def _(spark, sf):
    return t(spark, sf)["orders"].select("id", "total").orderBy(F.col("total").desc_nulls_first(), "id").limit(25)


@register("srt_3_mixed_directions", answer("id order_date:ts", "SELECT id, order_date FROM t_orders ORDER BY order_date DESC, id LIMIT 40"))
def _(spark, sf):
    return t(spark, sf)["orders"].select("id", "order_date").orderBy(F.col("order_date").desc(), F.col("id").asc()).limit(40)


@register("srt_5_array_sort", answer("product_id tags", """
    SELECT product_id, string_agg(tag, '|' ORDER BY tag) AS tags FROM t_tags GROUP BY product_id"""))
def _(spark, sf):
    return retail.raw_products(spark, sf).select(F.col("id").alias("product_id"), F.array_join(F.array_sort("tags"), "|").alias("tags"))


@register("set_1_union_all", answer("city n:i", """
    SELECT city, count(*) AS n FROM (
        SELECT n_name AS city FROM t_num WHERE has_own = 1 UNION ALL SELECT n_name FROM t_num WHERE has_work = 1) AS c GROUP BY city"""))
def _(spark, sf):
    users = retail.raw_users(spark, sf)
    own = users.filter("address IS NOT NULL").select("address.city")
    work = users.filter("company.address IS NOT NULL").select("company.address.city")
    return own.unionByName(work).groupBy("city").agg(F.count("*").alias("n"))


@register("set_2_distinct", answer("city state_code", "SELECT DISTINCT city, state_code FROM t_addresses"))
def _(spark, sf):
    return t(spark, sf)["addresses"].select("city", "state_code").dropDuplicates(["city", "state_code"])


@register("set_3_difference", answer("id", "SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'"))
def _(spark, sf):
    """Customers without an order of one status."""
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    pending = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id"))
    return customers.join(pending, "id", "left_anti")


@register("scl_text", answer("id full_name skipped slug has_at:b sku part", """
    SELECT c_custkey AS id, split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) AS full_name,
        coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, '') || '/' || c_name AS skipped,
        replace(lower(c_name || ' ' || c_mktsegment), ' ', '-') AS slug, contains(c_name, '@') AS has_at,
        'SKU-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS sku, split_part(c_name, '#', 2) AS part
    FROM customer"""))
def _(spark, sf):
    first, last = F.substring_index("c_name", "#", 1), F.substring_index("c_name", "#", -1)
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), display_name(first, last).alias("full_name"),
        concat_skip_nulls(F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")), F.lit("/"), "c_name").alias("skipped"),
        slug(F.concat_ws(" ", "c_name", "c_mktsegment")).alias("slug"), F.col("c_name").contains("@").alias("has_at"),
        F.format_string("SKU-%06d", "c_custkey").alias("sku"), last.alias("part"),
    )


@register("scl_dates", answer(
    "o_orderkey day:day month year:i quarter:i month_no:i day_no:i weekday:i iso_week:i month_name day_name next_week:day iso", """
    SELECT o_orderkey, o_orderdate AS day, strftime(o_orderdate, '%Y-%m') AS month, year(o_orderdate) AS year,
        quarter(o_orderdate) AS quarter, month(o_orderdate) AS month_no, day(o_orderdate) AS day_no, isodow(o_orderdate) AS weekday,
        weekofyear(o_orderdate) AS iso_week, monthname(o_orderdate) AS month_name, dayname(o_orderdate) AS day_name,
        CAST(o_orderdate AS DATE) + 7 AS next_week, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso
    FROM orders"""))
def _(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.to_date(d).alias("day"), F.date_format(d, "yyyy-MM").alias("month"), F.year(d).alias("year"),
        F.quarter(d).alias("quarter"), F.month(d).alias("month_no"), F.dayofmonth(d).alias("day_no"),
        (F.weekday(d) + 1).alias("weekday"), F.weekofyear(d).alias("iso_week"), F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"), F.date_add(F.to_date(d), 7).alias("next_week"),
        F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss").alias("iso"),
    )


@register("scl_numbers", answer("l_orderkey net:d ratio:d fiscal:i cast_back:d", f"""
    SELECT l_orderkey, round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS net,
        {mean("CAST(l_extendedprice AS DECIMAL(12,2))", "CAST(l_quantity AS BIGINT)")} AS ratio,
        ((month(l_shipdate) + 2) % 12) // 3 + 1 AS fiscal, l_tax AS cast_back FROM lineitem"""))
def _(spark, sf):
    amount, rate = F.col("l_extendedprice").cast("decimal(12,2)"), F.col("l_discount").cast("decimal(4,2)")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", F.round(amount - amount * rate, 2).alias("net"),
        mean_money(amount, F.col("l_quantity").cast("bigint")).alias("ratio"),
        (F.call_function("div", F.pmod(F.month("l_shipdate") - 10, F.lit(12)), F.lit(3)) + 1).alias("fiscal"),
        F.col("l_tax").cast("string").try_cast("double").alias("cast_back"),
    )


@register("scl_json_round_trip", answer("event_id k:i value:d", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value FROM events"""))
def _(spark, sf):
    parsed = F.from_json("props", "k BIGINT")
    packed = F.to_json(F.struct("event_id", parsed.alias("props"), "value"), {"ignoreNullFields": "false"})
    back = F.from_json(packed, "event_id BIGINT, props STRUCT<k: BIGINT>, value DOUBLE")
    return table(spark, sf, "events").select(back.alias("r")).select("r.event_id", F.col("r.props.k").alias("k"), "r.value")
