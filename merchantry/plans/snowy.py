"""Queries over the snowflake model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantry.functions.money import mean_money, percent_of
from merchantry.plans.common import (
    among, best_known_label, distinct, mean_line, mean_of, mean_parts, order_sums, ranked, sold_lines, top, total,
)
from merchantry.plans.starry import newest_facts
from merchantry.sources.store import settle

Tables = dict[str, DataFrame]


def categories_with_parent(m: Tables) -> DataFrame:
    parents = m["dim_categories"].select(
        F.col("category_id").alias("parent_category_id"), F.col("category_name").alias("parent_category")
    )
    return m["dim_categories"].join(parents, "parent_category_id", "left").select(
        "category_id", "category_name", "category_slug", "parent_category"
    )


def cities_with_state(m: Tables) -> DataFrame:
    return m["dim_cities"].select("city_id", "city_name", "state_id", "population").join(
        m["dim_states"].select("state_id", "state_name", "state_code", "region", "country"), "state_id", "left"
    )


def revenue_by_product(m: Tables, n: int = 50) -> DataFrame:
    """Sales measures per product with category, parent category and brand."""
    sold = m["fact_orders"].groupBy("product_id").agg(
        distinct("order_id", "total_orders"), total("quantity", "total_quantity_sold"),
        total("total_amount", "total_revenue"), total("discount_amount", "total_discounts"), *mean_parts("unit_price"),
    )
    products = m["dim_products"].select("product_id", "title", "category_id", "brand_id")
    rows = top(sold.join(products, "product_id"), n, "total_revenue", "product_id")
    rows = rows.join(categories_with_parent(m), "category_id", "left").join(
        m["dim_brands"].select("brand_id", "brand_name", "brand_country"), "brand_id", "left"
    )
    return ranked(rows, "total_revenue", "product_id").select(
        "product_id", "title", "category_name", "category_slug", "parent_category", "brand_name", "brand_country",
        "total_orders", "total_quantity_sold", "total_revenue", "total_discounts", mean_of("unit_price", "avg_selling_price"),
    )


def _per_customer(m: Tables) -> DataFrame:
    """Orders and sums per customer, for the geographic queries."""
    return order_sums(m).groupBy("user_id").agg(
        F.count("*").alias("_orders"), total("_quantity", "_quantity"), total("_amount", "_amount"), total("_lines", "_lines")
    )


def top_users(m: Tables, n: int = 100) -> DataFrame:
    """Users by lifetime value with role and city, state, region."""
    users = m["dim_users"].select("user_id", "username", "full_name", "email", "age", "role_id", "city_id")
    rows = top(_per_customer(m).join(users, "user_id"), n, "_amount", "user_id")
    rows = rows.join(m["dim_user_roles"], "role_id", "left").join(cities_with_state(m), "city_id", "left")
    return ranked(rows, "_amount", "user_id").select(
        "user_id", "username", "full_name", "email", "age", "role_name", "role_description", "city_name",
        F.col("population").alias("city_population"), "state_name", "state_code", "region", "country",
        F.col("_orders").alias("total_orders"), F.col("_quantity").alias("total_items"),
        F.col("_amount").alias("lifetime_value"), mean_money("_amount", "_lines").alias("avg_order_value"),
    )


def _per_city(m: Tables) -> DataFrame:
    """Customers, orders and sums per city with its state; customers without a city share a row of nulls.

    An order has one user and a user has one city, so the counts of the levels add up.
    """
    customers = _per_customer(m).join(m["dim_users"].select("user_id", "city_id"), "user_id")
    cities = customers.groupBy("city_id").agg(
        F.count("*").alias("_customers"), total("_orders", "_orders"), total("_amount", "_amount"), total("_lines", "_lines")
    )
    return cities.join(cities_with_state(m), "city_id", "left")


def _by_place(cities: DataFrame, keys: list[str], revenue: str, customers: str, *counts) -> DataFrame:
    return cities.groupBy(*keys).agg(
        *counts, total("_customers", customers), total("_orders", "total_orders"), total("_amount", revenue),
        total("_lines", "_line_count"),
    )


def revenue_by_region(m: Tables) -> DataFrame:
    rows = _by_place(
        _per_city(m), ["region", "country"], "regional_revenue", "customers_in_region",
        distinct("state_id", "states_in_region"), F.count("city_id").alias("cities_in_region"),
    )
    return ranked(rows, "regional_revenue", "region").select(
        "region", "country", "states_in_region", "cities_in_region", "customers_in_region", "total_orders",
        "regional_revenue", mean_line("regional_revenue", "avg_order_value"),
    )


def revenue_by_state(m: Tables, n: int = 50) -> DataFrame:
    rows = _by_place(
        _per_city(m).filter(F.col("state_name").isNotNull()), ["state_name", "state_code", "region"], "state_revenue",
        "customers_in_state", F.count("city_id").alias("cities_in_state"),
    )
    return top(rows, n, "state_revenue", "state_code").select(
        "state_name", "state_code", "region", "cities_in_state", "customers_in_state", "total_orders", "state_revenue",
        mean_line("state_revenue", "avg_order_value"),
    )


def revenue_by_city(m: Tables, n: int = 100) -> DataFrame:
    keys = ["city_name", "state_name", "state_code", "region", "population"]
    rows = _by_place(_per_city(m).filter(F.col("city_name").isNotNull()), keys, "city_revenue", "customers_in_city")
    return top(rows, n, "city_revenue", "city_name", "state_code").select(
        *keys, "customers_in_city", "total_orders", "city_revenue", mean_line("city_revenue", "avg_order_value")
    )


def category_performance(m: Tables) -> DataFrame:
    """Measures per category with parent, market share and best-selling brand."""
    products = m["dim_products"].select("product_id", "category_id", "brand_id")
    facts = sold_lines(m)
    per_product = facts.groupBy("product_id").agg(
        total("quantity", "_quantity"), total("total_amount", "_revenue"), *mean_parts("unit_price")
    )
    brands = per_product.join(products, "product_id").groupBy("category_id", "brand_id").agg(
        F.count("*").alias("_products"), total("_quantity", "_quantity"), total("_revenue", "_revenue"),
        total("_sum_unit_price", "_prices"), total("_n_unit_price", "_priced"),
    ).join(m["dim_brands"].select("brand_id", "brand_name"), "brand_id", "left")
    sums = brands.groupBy("category_id").agg(
        total("_products", "products_count"), total("_quantity", "total_quantity_sold"), total("_revenue", "total_revenue"),
        total("_prices", "_prices"), total("_priced", "_priced"), best_known_label("brand_name", "_revenue").alias("top_brand"),
    ).join(categories_with_parent(m), "category_id")
    shared = sums.withColumn("_whole", sums.agg(F.sum("total_revenue").alias("whole")).scalar())
    orders = facts.select("product_id", "order_id").join(products.drop("brand_id"), "product_id").groupBy(
        "category_id"
    ).agg(distinct("order_id", "orders_count"))
    return ranked(shared.join(orders, "category_id"), "total_revenue", "category_id").select(
        "category_name", "category_slug", "parent_category", "products_count", "orders_count", "total_quantity_sold",
        "total_revenue", mean_money("_prices", "_priced").alias("avg_product_price"),
        percent_of("total_revenue", "_whole").alias("market_share_percent"), "top_brand",
    )


def product_ranking(m: Tables, n: int = 50) -> DataFrame:
    """The short form of ``revenue_by_product``."""
    sold = m["fact_orders"].groupBy("product_id").agg(
        distinct("order_id", "total_orders"), total("quantity", "total_quantity"), total("total_amount", "total_revenue")
    )
    products = m["dim_products"].select("product_id", "title", "category_id", "brand_id")
    rows = top(sold.join(products, "product_id"), n, "total_revenue", "product_id")
    rows = rows.join(m["dim_categories"].select("category_id", "category_name"), "category_id", "left").join(
        m["dim_brands"].select("brand_id", "brand_name"), "brand_id", "left"
    )
    return ranked(rows, "total_revenue", "product_id").select(
        "product_id", "title", "category_name", "brand_name", "total_orders", "total_quantity", "total_revenue"
    )


def wide_join(m: Tables, n: int = 1000) -> DataFrame:
    """The newest order lines with the names of everything they refer to."""
    newest = settle(newest_facts(m, n))
    products = among(m["dim_products"].select("product_id", F.col("title").alias("product_name"), "category_id"), "product_id", newest)
    users = among(m["dim_users"].select("user_id", "username", "city_id"), "user_id", newest)
    rows = newest.join(users, "user_id").join(products, "product_id")
    rows = rows.join(m["dim_categories"].select("category_id", "category_name"), "category_id", "left")
    return rows.join(m["dim_cities"].select("city_id", "city_name"), "city_id", "left").select(
        "order_id", "username", "product_name", "category_name", "city_name", "quantity", "total_amount"
    )
