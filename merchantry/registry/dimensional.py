"""Dimension and fact builders."""

from __future__ import annotations

from pyspark.sql import functions as F

from merchantry.functions.regions import region_of
from merchantry.operators import dimensions as d
from merchantry.plans import increments, models
from merchantry.registry.base import REGION_CASE, answer, register
from merchantry.sources import retail
from merchantry.sources.retail import table
from merchantry.sources.store import scratch_path

NAME = "first_name || ' ' || last_name AS full_name"


def t(spark, sf):
    return models.normalized(spark, sf)


@register("dim_1_star_users", answer(
    "user_id username email first_name last_name full_name age:i gender phone birth_date:day blood_group:s university role",
    f"SELECT id AS user_id, *, {NAME}, NULL AS blood_group FROM t_users"))
def _(spark, sf):
    return d.star_users(t(spark, sf))


PRODUCT = ("product_id title description {} sku price:d discount_percentage:d rating:d stock:i weight:d warranty_info "
           "availability_status")


@register("dim_2_star_products", answer(PRODUCT.format("category brand"), "SELECT id AS product_id, * FROM t_sprod"))
def _(spark, sf):
    return d.star_products(t(spark, sf))


@register("dim_3_date", answer(
    "date_id:i full_date:day year:i quarter:i month:i month_name day:i day_of_week:i day_name week_of_year:i is_weekend is_holiday "
    "fiscal_year:i fiscal_quarter:i order_count:i", """
    SELECT d.*, coalesce(n, 0) AS order_count FROM t_dates d
    LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day_, count(*) AS n FROM orders GROUP BY 1) AS o ON d.full_date = o.day_"""))
def _(spark, sf):
    """The calendar of the order years with the orders of each day."""
    per_day = retail.table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("full_date")).agg(F.count("*").alias("n"))
    return d.calendar_of(t(spark, sf)["orders"]).join(per_day, "full_date", "left").withColumn(
        "order_count", F.coalesce("n", F.lit(0))
    ).drop("n")


@register("dim_4_region", answer("state_code region addresses:i", f"""
    SELECT state_code, {REGION_CASE} AS region, count(*) AS addresses FROM t_addresses GROUP BY state_code"""))
def _(spark, sf):
    return t(spark, sf)["addresses"].groupBy("state_code").agg(F.count("*").alias("addresses")).withColumn(
        "region", region_of("state_code")
    )


@register("dim_5_location", answer(
    "location_id address_line city state state_code postal_code country region latitude:d longitude:d", "SELECT * FROM t_locations"))
def _(spark, sf):
    return d.star_locations(t(spark, sf))


@register("dim_6_address_location", answer("address_id location_id:i", """
    SELECT a.id AS address_id, l.location_id FROM t_addresses a JOIN (
        SELECT city, state_code, postal_code, min(location_id) AS location_id FROM t_locations GROUP BY ALL) AS l
    ON a.city = l.city AND a.state_code = l.state_code AND a.postal_code = l.postal_code"""))
def _(spark, sf):
    tables = t(spark, sf)
    return d.address_locations(tables["addresses"], d.star_locations(tables))


@register("dim_7_date_lookup", answer("id date_id:i", """
    SELECT id, CASE WHEN year(order_date) BETWEEN 1995 AND 1997 THEN CAST(CAST(order_date AS DATE) - DATE '1995-01-01' AS BIGINT) + 1
        ELSE CAST(strftime(order_date, '%Y%m%d') AS BIGINT) END AS date_id FROM t_orders"""))
def _(spark, sf):
    """A calendar of three years only: later orders get the YYYYMMDD number."""
    return d.date_ids(t(spark, sf)["orders"], d.date_dimension(spark, 1995, 1997)).select("id", "date_id")


FACT = ("fact_id order_id user_id product_id date_id:i quantity:i unit_price:d discount_percentage:d discount_amount:d subtotal:d "
        "total_amount:d order_status")


@register("dim_8_star_fact", answer(FACT + " location_id:i", "SELECT * FROM t_fact"))
def _(spark, sf):
    tables = t(spark, sf)
    return d.build_star(tables)["fact_orders"]


@register("dim_9_user_roles", answer("role_id:i role_name role_description", "SELECT * FROM t_roles"))
def _(spark, sf):
    return d.user_roles(t(spark, sf)["users"])


@register("dim_10_categories", answer(
    "category_id:i category_name category_slug parent_category_id:i",
    "SELECT id AS category_id, name AS category_name, slug AS category_slug, NULL AS parent_category_id FROM t_categories"))
def _(spark, sf):
    return d.snow_categories(t(spark, sf))


@register("dim_11_brands", answer(
    "brand_id:i brand_name brand_country:s brand_website:s", "SELECT *, NULL AS brand_website FROM t_brands"))
def _(spark, sf):
    return d.snow_brands(t(spark, sf))


@register("dim_12_states", answer("state_id:i state_name state_code region country", "SELECT * FROM t_states"))
def _(spark, sf):
    return d.snow_states(t(spark, sf))


@register("dim_13_cities", answer(
    "city_id:i city_name state_id:i population:i timezone:s", "SELECT *, NULL AS timezone FROM t_cities"))
def _(spark, sf):
    tables = t(spark, sf)
    return d.snow_cities(tables, d.snow_states(tables))


@register("dim_14_snow_users", answer(
    "user_id username email first_name last_name full_name age:i gender phone birth_date:day blood_group:s university role_id:i "
    "city_id:i postal_code latitude:d longitude:d", f"SELECT id AS user_id, *, {NAME}, NULL AS blood_group FROM t_snowusers"))
def _(spark, sf):
    tables, built = t(spark, sf), models.snowflake(spark, sf)
    return d.snow_users(tables, built["dim_user_roles"], built["dim_states"], built["dim_cities"])


@register("dim_15_snow_products", answer(PRODUCT.format("category_id:i brand_id:i"), "SELECT id AS product_id, * FROM t_snowprod"))
def _(spark, sf):
    tables, built = t(spark, sf), models.snowflake(spark, sf)
    return d.snow_products(tables, built["dim_categories"], built["dim_brands"])


@register("dim_16_snow_fact", answer(FACT, "SELECT * FROM t_fact"))
def _(spark, sf):
    return d.build_snowflake(t(spark, sf))["fact_orders"]


STAR_COUNTS = [("dim_date", "t_dates"), ("dim_users", "t_users"), ("dim_products", "t_products"), ("dim_location", "t_locations"),
               ("fact_orders", "t_fact")]
SNOW_COUNTS = [("dim_user_roles", "t_roles"), ("dim_states", "t_states"), ("dim_cities", "t_cities"),
               ("dim_categories", "t_categories"), ("dim_brands", "t_brands"), ("dim_date", "t_dates"), ("dim_users", "t_users"),
               ("dim_products", "t_products"), ("fact_orders", "t_fact")]
FLAT_COUNTS = [("addresses", "t_addresses"), ("banks", "t_banks"), ("companies", "t_companies"), ("users", "t_users"),
               ("categories", "t_categories"), ("products", "t_products"), ("product_tags", "t_tags"),
               ("product_images", "t_images"), ("reviews", "t_reviews"), ("orders", "t_orders"), ("order_items", "t_items")]


def counts_sql(pairs: list[tuple[str, str]]) -> str:
    body = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {c}" for n, c in pairs)
    return answer("table_name row_count:i", body)


@register("dim_17_star_build", counts_sql(STAR_COUNTS))
def _(spark, sf):
    return d.row_counts(models.declared("star", models.star(spark, sf)))


@register("dim_17_snowflake_build", counts_sql(SNOW_COUNTS))
def _(spark, sf):
    return d.row_counts(models.declared("snowflake", models.snowflake(spark, sf)))


def _grown(spark, sf, model):
    """A model built without the last hundredth of the orders, and extended when they come."""
    source, folder = scratch_path(spark, "growing"), scratch_path(spark, "grown")
    for name in ("region", "nation", "customer", "part"):
        table(spark, sf, name).write.parquet(f"{source}/{name}.parquet")
    top = table(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0]
    for part in ("{0} <= {1}", "{0} > {1}"):
        for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
            table(spark, sf, name).filter(part.format(key, int(top * 0.99))).write.mode("append").parquet(f"{source}/{name}.parquet")
        tables = increments.update(spark, source, folder, model)
    return increments.model_tables(model, tables)


@register("dim_17_star_increment", answer(FACT + " location_id:i", "SELECT * FROM t_fact"))
def _(spark, sf):
    return _grown(spark, sf, "star")["fact_orders"]


@register("dim_17_snowflake_increment", counts_sql(SNOW_COUNTS))
def _(spark, sf):
    return d.row_counts(_grown(spark, sf, "snowflake"))


@register("dim_18_row_counts", counts_sql(FLAT_COUNTS))
def _(spark, sf):
    return d.row_counts(t(spark, sf))
