"""Normalizing nested entities and nesting flat tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from merchantry.functions.numbering import id_by_key, running_totals
from merchantry.operators import dimensions, documents, normalize
from merchantry.plans import models
from merchantry.registry.base import answer, register
from merchantry.registry.dimensional import FLAT_COUNTS, counts_sql
from merchantry.sources import retail

ANCHOR = "2025-12-01"


def t(spark, sf):
    return models.normalized(spark, sf)


@register("nrm_1_split_users", answer(
    "id first_name last_name age:i gender email phone username birth_date:day height:d weight:d hair_color university role "
    "crypto_coin crypto_wallet bank_id:i company_id:i address_id:i", "SELECT * FROM t_users"))
def _(spark, sf):
    users = normalize.normalize_users(retail.raw_users(spark, sf))["users"]
    return users.select(
        "id", "first_name", "last_name", "age", "gender", "email", "phone", "username", "birth_date", "height", "weight",
        "hair_color", "university", "role", "crypto_coin", "crypto_wallet", "bank_id", "company_id", "address_id",
    )


@register("nrm_1_split_banks", answer("id card_number card_type card_expire currency iban", "SELECT * FROM t_banks"))
def _(spark, sf):
    return normalize.normalize_users(retail.raw_users(spark, sf))["banks"]


@register("nrm_1_split_companies", answer("id name department title address_id:i", "SELECT * FROM t_companies"))
def _(spark, sf):
    return normalize.normalize_users(retail.raw_users(spark, sf))["companies"]


@register("nrm_2_interleaved_ids", answer("id address_id:i company_address_id:i bank_id:i company_id:i", """
    SELECT u.id, u.address_id, c.address_id AS company_address_id, u.bank_id, u.company_id FROM t_users u
    LEFT JOIN t_companies c ON u.company_id = c.id"""))
def _(spark, sf):
    return normalize.number_user_parts(retail.raw_users(spark, sf)).select(
        "id", "address_id", "company_address_id", "bank_id", "company_id"
    )


LOST_KEYS = "CASE WHEN c_custkey % 7 <> 3 THEN c_custkey END"


@register("nrm_2_null_keys", answer("users:i keyless:i first_id:i last_id:i distinct_ids:i keyed_first:b", f"""
    SELECT count(*) AS users, count(*) FILTER ({LOST_KEYS} IS NULL) AS keyless, 1 AS first_id, count(*) AS last_id,
        count(*) AS distinct_ids, TRUE AS keyed_first FROM customer"""))
def _(spark, sf):
    """Every seventh user has lost its key: all stay, and ids run on behind the last key without a gap."""
    users = retail.raw_users(spark, sf).withColumn("key", F.expr(LOST_KEYS.replace("c_custkey", "id")))
    numbered = id_by_key(users.select("key", "username"), "key", "n")
    keyless = F.col("key").isNull()
    return numbered.agg(
        F.count("*").alias("users"), F.count_if(keyless).alias("keyless"), F.min("n").alias("first_id"), F.max("n").alias("last_id"),
        F.count_distinct("n").alias("distinct_ids"),
        (F.max(F.when(~keyless, F.col("n"))) < F.min(F.when(keyless, F.col("n")))).alias("keyed_first"),
    )


@register("nrm_2_sparse_keys", answer("key n:i before:i", """
    SELECT o_orderkey * 1048583 - 5 AS key, row_number() OVER (ORDER BY o_orderkey) AS n,
        coalesce(sum(CAST(round(o_totalprice) AS BIGINT)) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM orders"""))
def _(spark, sf):
    """Keys a million apart: as many blocks as rows."""
    orders = retail.table(spark, sf, "orders").select((F.col("o_orderkey") * 1048583 - 5).alias("key"), F.round("o_totalprice").cast("bigint").alias("w"))
    return running_totals(orders, "key", {"before": F.col("w"), "rows_before": F.lit(1)}).select(
        "key", (F.col("rows_before") + 1).alias("n"), "before")


ADDRESS = "id address_line city state state_code postal_code country latitude:d longitude:d"


@register("nrm_3_own_addresses", answer(ADDRESS, "SELECT a.* FROM t_addresses a JOIN t_users u ON u.address_id = a.id"))
def _(spark, sf):
    parts = normalize.number_user_parts(retail.raw_users(spark, sf)).filter(F.col("address_id").isNotNull())
    own = parts.select(F.col("address_id").alias("id"), *normalize.address_columns("address"))
    return own.withColumn("country", F.coalesce("country", F.lit("United States")))


@register("nrm_4_all_addresses", answer(ADDRESS, "SELECT * FROM t_addresses"))
def _(spark, sf):
    return normalize.normalize_users(retail.raw_users(spark, sf))["addresses"]


@register("nrm_5_categories", answer("id:i name slug", "SELECT * FROM t_categories"))
def _(spark, sf):
    return normalize.categories_of(retail.raw_products(spark, sf))


@register("nrm_6_products", answer(
    "id title description category_id:i price:d discount_percentage:d rating:d stock:i brand sku weight:d width:d height:d depth:d "
    "warranty_info shipping_info:s availability_status return_policy:s minimum_order_quantity:i barcode qr_code_url:s thumbnail_url "
    "created_at:ts updated_at:ts",
    "SELECT *, NULL AS shipping_info, NULL AS return_policy, NULL AS qr_code_url FROM t_products"))
def _(spark, sf):
    return normalize.normalize_products(retail.raw_products(spark, sf))["products"]


@register("nrm_7_tags", answer("id:i product_id tag", "SELECT * FROM t_tags"))
def _(spark, sf):
    return normalize.normalize_products(retail.raw_products(spark, sf))["product_tags"]


@register("nrm_8_images", answer("id:i product_id image_url image_order:i", "SELECT * FROM t_images"))
def _(spark, sf):
    return normalize.normalize_products(retail.raw_products(spark, sf))["product_images"]


@register("nrm_9_reviews", answer(
    "id:i product_id rating:i comment reviewer_name reviewer_email review_date:ts", "SELECT * FROM t_reviews"))
def _(spark, sf):
    return normalize.normalize_products(retail.raw_products(spark, sf))["reviews"]


@register("nrm_10_orders", answer(
    "id user_id total:d discounted_total:d total_products:i total_quantity:i", "SELECT * FROM t_orders"))
def _(spark, sf):
    orders = normalize.normalize_carts(retail.raw_carts(spark, sf), ANCHOR)["orders"]
    return orders.drop("order_date", "status")


@register("nrm_10_order_items", answer(
    "id:i order_id product_id quantity:i price:d discount_percentage:d discounted_total:d total:d", "SELECT * FROM t_items"))
def _(spark, sf):
    return normalize.normalize_carts(retail.raw_carts(spark, sf), ANCHOR)["order_items"]


@register("nrm_11_synthetic_dates", answer("id in_year:b in_hours:b known_status:b", """
    SELECT id, TRUE AS in_year, TRUE AS in_hours, TRUE AS known_status FROM t_orders"""))
def _(spark, sf):
    """The generated order dates and statuses stay within their ranges."""
    orders = normalize.normalize_carts(retail.raw_carts(spark, sf), ANCHOR)["orders"]
    age = F.datediff(F.lit(ANCHOR).cast("date"), F.to_date("order_date"))
    return orders.select(
        "id", age.between(0, 365).alias("in_year"), F.hour("order_date").between(9, 21).alias("in_hours"),
        F.col("status").isin(normalize.ORDER_STATUSES).alias("known_status"),
    )


@register("nrm_12_all_tables", counts_sql(FLAT_COUNTS))
def _(spark, sf):
    return dimensions.row_counts(normalize.normalize(
        retail.raw_users(spark, sf), retail.raw_products(spark, sf), retail.raw_carts(spark, sf), ANCHOR
    ))


@register("doc_1_users", answer(
    "_id username hair_color crypto_coin address_city address_lat:d bank_iban company_name company_city has_address:b has_bank:b "
    "has_company_address:b", """
    SELECT u.id AS _id, u.username, u.hair_color, u.crypto_coin, a.city AS address_city, a.latitude AS address_lat, b.iban AS bank_iban,
        c.name AS company_name, ca.city AS company_city, a.id IS NOT NULL AS has_address, b.id IS NOT NULL AS has_bank,
        ca.id IS NOT NULL AS has_company_address
    FROM t_users u LEFT JOIN t_addresses a ON u.address_id = a.id LEFT JOIN t_banks b ON u.bank_id = b.id
    LEFT JOIN t_companies c ON u.company_id = c.id LEFT JOIN t_addresses ca ON c.address_id = ca.id"""))
def _(spark, sf):
    return documents.user_documents(t(spark, sf)).select(
        "_id", "username", F.col("hair.color").alias("hair_color"), F.col("crypto.coin").alias("crypto_coin"),
        F.col("address.city").alias("address_city"), F.col("address.coordinates.lat").alias("address_lat"),
        F.col("bank.iban").alias("bank_iban"), F.col("company.name").alias("company_name"),
        F.col("company.address.city").alias("company_city"), F.col("address").isNotNull().alias("has_address"),
        F.col("bank").isNotNull().alias("has_bank"), F.col("company.address").isNotNull().alias("has_company_address"),
    )


def _joined(array: str, element) -> F.Column:
    return F.array_join(F.transform(array, element), "|")


@register("doc_2_products", answer("_id title price:d width:d barcode category_slug tags images reviews", """
    SELECT p.id AS _id, p.title, p.price, p.width, p.barcode, c.slug AS category_slug,
        coalesce((SELECT string_agg(tag, '|' ORDER BY id) FROM t_tags x WHERE x.product_id = p.id), '') AS tags,
        coalesce((SELECT string_agg(image_url, '|' ORDER BY image_order, id) FROM t_images x WHERE x.product_id = p.id), '') AS images,
        coalesce((SELECT string_agg(CAST(rating AS VARCHAR) || ':' || comment, '|' ORDER BY id) FROM t_reviews x
            WHERE x.product_id = p.id), '') AS reviews
    FROM t_products p LEFT JOIN t_categories c ON p.category_id = c.id"""))
def _(spark, sf):
    return documents.product_documents(t(spark, sf)).select(
        "_id", "title", "price", F.col("dimensions.width").alias("width"), F.col("meta.barcode").alias("barcode"),
        F.col("category.slug").alias("category_slug"), F.array_join("tags", "|").alias("tags"),
        F.array_join("images", "|").alias("images"),
        _joined("reviews", lambda r: F.concat(r["rating"].cast("string"), F.lit(":"), r["comment"])).alias("reviews"),
    )


ORDER_DOCS = """
    SELECT o.id AS _id, o.order_date, o.total, u.username,
        coalesce(string_agg(CAST(i.product_id AS VARCHAR) || 'x' || CAST(i.quantity AS VARCHAR) || '@' || CAST(i.price AS VARCHAR)
            || p.title || c.name, '|' ORDER BY i.id), '') AS items
    FROM t_orders o LEFT JOIN t_users u ON o.user_id = u.id LEFT JOIN t_items i ON o.id = i.order_id
    LEFT JOIN t_products p ON i.product_id = p.id LEFT JOIN t_categories c ON p.category_id = c.id
    GROUP BY o.id, o.order_date, o.total, u.username"""


@register("doc_3_orders", answer("_id order_date:ts total:d username items", ORDER_DOCS))
def _(spark, sf):
    line = lambda i: F.concat(
        i["product_id"].cast("string"), F.lit("x"), i["quantity"].cast("string"), F.lit("@"), i["price"].cast("string"),
        i["title"], i["category"],
    )
    return documents.order_documents(t(spark, sf)).select(
        "_id", "order_date", "total", F.col("user.username").alias("username"), _joined("items", line).alias("items")
    )


@register("doc_4_group_children", answer("conv_id turns:i roles texts", """
    SELECT conv_id, count(*) AS turns, string_agg(role, '|' ORDER BY turn) AS roles,
        string_agg(text, '|' ORDER BY turn) AS texts
    FROM conversations GROUP BY conv_id"""))
def _(spark, sf):
    """Whole conversations as one array per conversation, in turn order."""
    turns = retail.table(spark, sf, "conversations").select("conv_id", "turn", F.struct("role", "text").alias("said"))
    grouped = documents.embed(
        turns.select("conv_id").distinct(), "conv_id", {"said": documents.Children(turns, "conv_id", ["turn"], "said")}
    )
    return grouped.select(
        "conv_id", F.size("said").alias("turns"), _joined("said", lambda s: s["role"]).alias("roles"),
        _joined("said", lambda s: s["text"]).alias("texts"),
    )


@register("doc_5_collections", counts_sql([("users", "t_users"), ("products", "t_products"), ("orders", "t_orders")]))
def _(spark, sf):
    return dimensions.row_counts(models.collections(spark, sf))
