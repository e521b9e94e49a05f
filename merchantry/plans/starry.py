"""Queries over the star model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchantry.functions.money import mean_money, percent_of
from merchantry.operators.quality import key_blocks, known_rows
from merchantry.plans.common import (
    among, best_label, calendar, distinct, mean_line, mean_of, mean_parts, months_of, order_sums, ranked, sold_lines, top, total,
)
from merchantry.sources.store import MONTH, settle

Tables = dict[str, DataFrame]


def revenue_by_product(m: Tables, n: int = 50) -> DataFrame:
    """Sales measures per product, best sellers first."""
    sold = m["fact_orders"].groupBy("product_id").agg(
        distinct("order_id", "total_orders"), total("quantity", "total_quantity_sold"), total("subtotal", "total_subtotal"),
        total("discount_amount", "total_discounts_given"), total("total_amount", "total_revenue"), *mean_parts("unit_price"),
    )
    products = m["dim_products"].select("product_id", "title", "category", "brand", F.col("price").alias("current_price"))
    return top(sold.join(products, "product_id"), n, "total_revenue", "product_id").select(
        "product_id", "title", "category", "brand", "current_price", "total_orders", "total_quantity_sold",
        "total_subtotal", "total_discounts_given", "total_revenue", mean_of("unit_price", "avg_selling_price"),
        mean_money("total_revenue", "total_quantity_sold").alias("revenue_per_unit"),
    )


def top_users(m: Tables, n: int = 100) -> DataFrame:
    """Users by lifetime value with first and last purchase."""
    orders = order_sums(m).join(calendar(m["dim_date"], "full_date"), "date_id")
    spent = orders.groupBy("user_id").agg(
        F.count("*").alias("total_orders"), total("_quantity", "total_items_purchased"), total("_amount", "lifetime_value"),
        total("_discounts", "total_discounts_received"), total("_lines", "_line_count"),
        distinct("date_id", "days_with_purchases"), F.min("full_date").alias("first_purchase_date"),
        F.max("full_date").alias("last_purchase_date"),
    )
    users = m["dim_users"].select("user_id", "username", "full_name", "email", "age", "gender", "role")
    return top(spent.join(users, "user_id"), n, "lifetime_value", "user_id").select(
        "user_id", "username", "full_name", "email", "age", "gender", "role", "total_orders", "total_items_purchased",
        "lifetime_value", "total_discounts_received", mean_line("lifetime_value", "avg_transaction_value"),
        "days_with_purchases", "first_purchase_date", "last_purchase_date",
    )


def _by_period(m: Tables, keys: list[str], revenue: str, *more, orders: DataFrame | None = None) -> DataFrame:
    """Orders per calendar period; orders of days outside the calendar are left out."""
    days = calendar(m["dim_date"], *sorted({*keys, "full_date"}))
    rows = order_sums(m) if orders is None else orders
    return rows.join(days, "date_id").groupBy(*keys).agg(
        F.count("*").alias("orders_count"), total("_quantity", "items_sold"), total("_amount", revenue),
        total("_lines", "_line_count"), *more,
    )


def _latest(m: Tables, keys: list[str], n: int) -> DataFrame:
    """The orders of the last ``n`` periods that have sales.

    Finding the days reads one column of the stored orders; of the months before the first of these days nothing else is read.
    """
    orders = order_sums(m)
    present = orders.select("date_id").distinct().join(calendar(m["dim_date"], "year", "month", *[k for k in keys if k != "year"]), "date_id")
    periods = present.select(*keys).distinct().orderBy(*[F.col(k).desc() for k in keys]).limit(n)
    days = present.join(F.broadcast(periods), keys, "left_semi")
    if MONTH in orders.columns:
        first = days.agg(F.min(F.col("year") * 100 + F.col("month")).alias("first")).scalar()
        orders = orders.filter(F.col(MONTH) >= first)
    return orders.join(F.broadcast(days.select("date_id")), "date_id", "left_semi")


def daily_revenue(m: Tables, days: int = 30) -> DataFrame:
    """The last days with sales."""
    rows = _by_period(m, ["full_date", "day_name", "is_weekend"], "daily_revenue", orders=_latest(m, ["full_date"], days))
    return rows.orderBy(F.col("full_date").desc()).limit(days).select(
        "full_date", "day_name", "is_weekend", "orders_count", "items_sold", "daily_revenue",
        mean_line("daily_revenue", "avg_order_value"),
    )


def weekly_revenue(m: Tables, weeks: int = 20) -> DataFrame:
    """By calendar year and ISO week, as defined: days of week 1 that lie in December stay in their year."""
    period = ["year", "week_of_year"]
    rows = _by_period(
        m, period, "weekly_revenue", F.min("full_date").alias("week_start"), F.max("full_date").alias("week_end"),
        orders=_latest(m, period, weeks),
    )
    return rows.orderBy(*[F.col(k).desc() for k in period]).limit(weeks).select(
        "year", "week_of_year", "week_start", "week_end", "orders_count", "items_sold", "weekly_revenue",
        mean_line("weekly_revenue", "avg_order_value"),
    )


def monthly_growth(m: Tables) -> DataFrame:
    """Monthly revenue with the previous month and the growth in percent."""
    rows = _by_period(
        m, ["year", "month", "month_name", "quarter"], "monthly_revenue", distinct("user_id", "unique_customers"),
        total("_discounts", "total_discounts"),
    )
    # one row per calendar month by now
    previous = F.lag("monthly_revenue").over(Window.orderBy("year", "month"))
    grown = rows.withColumn("prev_month_revenue", previous)
    return grown.orderBy(F.col("year").desc(), F.col("month").desc()).select(
        "year", "month", "month_name", "quarter", "orders_count", "unique_customers", "items_sold", "monthly_revenue",
        "total_discounts", mean_line("monthly_revenue", "avg_order_value"), "prev_month_revenue",
        percent_of(F.col("monthly_revenue") - F.col("prev_month_revenue"), "prev_month_revenue").alias("revenue_growth_percent"),
    )


def _by_customer_and_place(m: Tables, *place: str) -> DataFrame:
    """Orders summed per customer and location, then looked up: the location join sees no single orders."""
    orders = order_sums(m).filter(F.col("location_id").isNotNull())
    customers = orders.groupBy("user_id", "location_id").agg(
        F.count("*").alias("_orders"), total("_quantity", "_quantity"), total("_amount", "_amount"), total("_lines", "_lines")
    )
    return customers.join(m["dim_location"].select("location_id", *place), "location_id")


def revenue_by_location(m: Tables, n: int = 100) -> DataFrame:
    """Sales by country, region, state and city."""
    place = ["country", "region", "state", "city"]
    sold = _by_customer_and_place(m, *place).groupBy(*place).agg(
        total("_orders", "orders_count"), distinct("user_id", "unique_customers"), total("_quantity", "items_sold"),
        total("_amount", "total_revenue"), total("_lines", "_line_count"),
    )
    return top(sold, n, "total_revenue", *place).select(
        *place, "orders_count", "unique_customers", "items_sold", "total_revenue",
        mean_line("total_revenue", "avg_order_value"), mean_money("total_revenue", "unique_customers").alias("revenue_per_customer"),
    )


def revenue_by_region(m: Tables) -> DataFrame:
    """Sales by region; states and cities are counted among the locations that have sales.

    Three distinct counts, each in an aggregate of its own: of customers, of states and of cities.
    """
    sold = _by_customer_and_place(m, "region", "state", "city")
    sums = sold.groupBy("region").agg(
        distinct("user_id", "unique_customers"), total("_amount", "regional_revenue"), total("_lines", "_line_count")
    )
    states = sold.select("region", "state").distinct().groupBy("region").agg(F.count("state").alias("states_count"))
    cities = sold.select("region", "city").distinct().groupBy("region").agg(F.count("city").alias("cities_count"))
    return ranked(sums.join(states, "region").join(cities, "region"), "regional_revenue", "region").select(
        "region", "states_count", "cities_count", "unique_customers", "regional_revenue",
        mean_line("regional_revenue", "avg_order_value"),
    )


def category_performance(m: Tables) -> DataFrame:
    """Measures per category and its best-selling brand.

    Sums go from products to brands to categories; only the distinct order count reads fact rows by category.
    """
    products = m["dim_products"].select("product_id", "category", "brand")
    facts = sold_lines(m)
    per_product = facts.groupBy("product_id").agg(
        total("quantity", "_quantity"), total("total_amount", "_revenue"), total("discount_amount", "_discounts"),
        *mean_parts("unit_price"), F.count("total_amount").alias("_lines"),
    )
    brands = per_product.join(products, "product_id").groupBy("category", "brand").agg(
        F.count("*").alias("_products"), total("_quantity", "_quantity"), total("_revenue", "_revenue"),
        total("_discounts", "_discounts"), total("_sum_unit_price", "_prices"), total("_n_unit_price", "_priced"),
        total("_lines", "_lines"),
    )
    sums = brands.groupBy("category").agg(
        total("_products", "products_in_category"), total("_quantity", "total_quantity_sold"), total("_revenue", "total_revenue"),
        total("_discounts", "total_discounts"), total("_prices", "_prices"), total("_priced", "_priced"),
        total("_lines", "_line_count"), best_label("brand", "_revenue").alias("top_brand"),
    )
    orders = facts.select("product_id", "order_id").join(products, "product_id").groupBy("category").agg(
        distinct("order_id", "orders_count")
    )
    return ranked(sums.join(orders, "category"), "total_revenue", "category").select(
        "category", "products_in_category", "orders_count", "total_quantity_sold", "total_revenue", "total_discounts",
        mean_money("_prices", "_priced").alias("avg_product_price"), mean_line("total_revenue", "avg_transaction_value"),
        "top_brand",
    )


def product_ranking(m: Tables, n: int = 50) -> DataFrame:
    """The short form of ``revenue_by_product``."""
    sold = m["fact_orders"].groupBy("product_id").agg(
        distinct("order_id", "total_orders"), total("quantity", "total_quantity"), total("total_amount", "total_revenue")
    )
    products = m["dim_products"].select("product_id", "title", "category", "brand")
    return top(sold.join(products, "product_id"), n, "total_revenue", "product_id").select(
        "product_id", "title", "category", "brand", "total_orders", "total_quantity", "total_revenue"
    )


def user_ranking(m: Tables, n: int = 100) -> DataFrame:
    """The short form of ``top_users``; the same for star and snowflake."""
    spent = order_sums(m).groupBy("user_id").agg(F.count("*").alias("total_orders"), total("_amount", "lifetime_value"))
    users = m["dim_users"].select("user_id", "username", "full_name")
    return top(spent.join(users, "user_id"), n, "lifetime_value", "user_id").select(
        "user_id", "username", "full_name", "total_orders", "lifetime_value"
    )


def monthly_revenue(m: Tables) -> DataFrame:
    """Revenue per calendar month; the same for star and snowflake."""
    return _by_period(m, ["year", "month", "month_name"], "revenue").select(
        "year", "month", "month_name", "orders_count", "revenue"
    ).orderBy(F.col("year").desc(), F.col("month").desc())


def newest_facts(m: Tables, n: int, *keep: str) -> DataFrame:
    """The ``n`` newest fact rows with a known user, product and day; narrow until the limit is applied.

    Facts that are stored by month are counted from the newest month back, twice as many months each time, until ``n``
    rows are found: rows of earlier months cannot be among them, and the query reads none of these. Known users and products
    are kept 64 to a row: one narrow column of a wide stored table looks small to Spark, which would broadcast every key.
    """
    keys = {c: key_blocks(m[dimension], c) for dimension, c in (("dim_users", "user_id"), ("dim_products", "product_id"))}

    def known(fact: DataFrame) -> DataFrame:
        dated = fact.select(
            "fact_id", "order_id", "user_id", "product_id", "date_id", "quantity", "total_amount", *keep
        ).join(calendar(m["dim_date"], "full_date"), "date_id")
        return known_rows(known_rows(dated, "user_id", keys["user_id"]), "product_id", keys["product_id"])

    fact = m["fact_orders"]
    months = months_of(fact) if MONTH in fact.columns else []
    taken = 1
    while taken < len(months):
        latest = fact.filter(F.col(MONTH) >= months[taken - 1])
        if known(latest).limit(n).count() == n:
            fact = latest
            break
        taken *= 2
    return known(fact).orderBy(F.col("full_date").desc(), "fact_id").limit(n)


def wide_join(m: Tables, n: int = 1000) -> DataFrame:
    """The newest order lines with the names of everything they refer to."""
    newest = settle(newest_facts(m, n, "location_id"))
    users = among(m["dim_users"].select("user_id", "username"), "user_id", newest)
    products = among(m["dim_products"].select("product_id", F.col("title").alias("product_name"), "category"), "product_id", newest)
    places = among(m["dim_location"].select("location_id", "city"), "location_id", newest)
    rows = newest.join(users, "user_id").join(products, "product_id").join(places, "location_id", "left")
    return rows.select("order_id", "username", "product_name", "category", "city", "quantity", "total_amount")


def heavy_aggregate(m: Tables) -> DataFrame:
    """Global counts and sums; the same for star and snowflake. Products are counted in a scan of their own."""
    dated = calendar(m["dim_date"], "full_date")
    products = sold_lines(m).select("product_id", "date_id").join(calendar(m["dim_date"]), "date_id", "left_semi").agg(
        distinct("product_id", "n")
    )
    return order_sums(m).join(dated, "date_id").agg(
        F.count("*").alias("total_orders"), distinct("user_id", "unique_customers"), total("_quantity", "total_items"),
        total("_amount", "total_revenue"), total("_lines", "_line_count"), F.min("full_date").alias("first_order"),
        F.max("full_date").alias("last_order"),
    ).select(
        "total_orders", "unique_customers", products.scalar().alias("unique_products"), "total_items", "total_revenue",
        mean_line("total_revenue", "avg_order_value"), "first_order", "last_order",
    )
