"""Queries over the normalized tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantry.functions.money import mean_money
from merchantry.functions.text import concat_skip_nulls
from merchantry.plans.common import best, distinct, mean_of, mean_parts, ranked, top, total
from merchantry.sources.store import settle

Tables = dict[str, DataFrame]

# newest orders that are sent to all executors: some MB
BROADCAST_ORDERS = 1 << 16


def _full_name(prefix: str = ""):
    return concat_skip_nulls(f"{prefix}first_name", F.lit(" "), f"{prefix}last_name").alias("full_name")


def newest_lines(t: Tables, n: int) -> DataFrame:
    """The ``n`` newest order lines that have a known user and product.

    Lines come in the order of their orders, so the newest orders are taken first (``n`` of them, then 16 times as many) and
    broadcast to lines and users: neither is shuffled. If ``BROADCAST_ORDERS`` orders have too few valid lines, all meet.
    What was found is written (``n`` rows at most) and read back. Order ids are unique.
    """
    lines = t["order_items"].select(
        F.col("id").alias("item_id"), "order_id", "product_id", "quantity", F.col("price").alias("unit_price"),
        F.col("total").alias("item_total"),
    )
    orders = t["orders"].select(F.col("id").alias("order_id"), "order_date", "user_id", "status", "total", "discounted_total")
    users = t["users"].select(F.col("id").alias("user_id"))
    products = t["products"].select(F.col("id").alias("product_id"))
    newest = F.col("order_date").desc_nulls_first()

    def best_of(known: DataFrame) -> DataFrame:
        valid = lines.join(known, "order_id").join(products, "product_id", "left_semi")
        return valid.orderBy(newest, "order_id", "item_id").limit(n)

    taken = n
    while 0 < taken <= BROADCAST_ORDERS:
        some = orders.orderBy(newest, "order_id").limit(taken)
        buyers = users.join(F.broadcast(some.select("user_id")), "user_id", "left_semi").distinct()
        rows = settle(best_of(F.broadcast(some.join(buyers, "user_id", "left_semi"))))
        if rows.count() == n:
            return rows
        taken *= 16
    return best_of(orders.join(users, "user_id", "left_semi"))


def _looked_up(t: Tables, n: int) -> DataFrame:
    """Names for the ``n`` lines that are left; the join filters that Spark derives from them prune the larger tables."""
    users = t["users"].select(F.col("id").alias("user_id"), "username", "email", _full_name(), "address_id")
    products = t["products"].select(F.col("id").alias("product_id"), F.col("title").alias("product_name"), "brand", "category_id")
    categories = t["categories"].select(F.col("id").alias("category_id"), F.col("name").alias("category"))
    addresses = t["addresses"].select(F.col("id").alias("address_id"), "city", "state", "postal_code")
    rows = newest_lines(t, n).join(users, "user_id").join(products, "product_id")
    return rows.join(categories, "category_id", "left").join(addresses, "address_id", "left")


def order_lines(t: Tables, n: int = 100) -> DataFrame:
    """Order lines with user, address, product and category, newest first."""
    return _looked_up(t, n).orderBy(F.col("order_date").desc_nulls_first(), "order_id", "item_id").select(
        "order_id", "order_date", "status", "total", "discounted_total", "username", "email", "full_name", "city",
        "state", "postal_code", "quantity", "unit_price", "item_total", "product_name", "brand", "category",
    )


def revenue_by_user(t: Tables, n: int = 50) -> DataFrame:
    """Users by item revenue. Order totals count once per order line, as the query is defined.

    Lines are first summed per order, so the per-line sums of order columns are products with the line
    count and neither the lines nor a distinct count go through the join.
    """
    per_order = t["order_items"].groupBy("order_id").agg(
        F.count("*").alias("_lines"), F.count("id").alias("_items"), total("quantity", "_quantity"), total("total", "_total")
    )
    orders = t["orders"].join(per_order, F.col("id") == F.col("order_id"))
    per_user = orders.groupBy("user_id").agg(
        F.count("id").alias("total_orders"), total("_items", "total_items"), total("_quantity", "total_quantity"),
        total("_total", "total_revenue"),
        F.sum(F.col("discounted_total") * F.col("_lines")).alias("total_discounted_revenue"),
        F.sum(F.col("total") * F.col("_lines")).alias("_order_totals"),
        F.sum(F.when(F.col("total").isNotNull(), F.col("_lines"))).alias("_order_lines"),
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"),
    )
    users = t["users"].select(F.col("id").alias("user_id"), "username", _full_name(), "email", "address_id")
    rows = top(per_user.join(users, "user_id"), n, "total_revenue", "user_id")
    addresses = t["addresses"].select(F.col("id").alias("address_id"), "city", "state")
    return rows.join(addresses, "address_id", "left").select(
        "user_id", "username", "full_name", "email", "city", "state", "total_orders", "total_items", "total_quantity",
        "total_revenue", "total_discounted_revenue", mean_money("_order_totals", "_order_lines").alias("avg_order_value"),
        "first_order_date", "last_order_date",
    ).orderBy(F.col("total_revenue").desc_nulls_first(), "user_id")


def revenue_by_user_per_order(t: Tables, n: int = 50) -> DataFrame:
    """Users by order revenue with every order counted once."""
    per_user = t["orders"].groupBy("user_id").agg(
        F.count("id").alias("total_orders"), total("total", "total_revenue"),
        total("discounted_total", "total_discounted_revenue"), *mean_parts("total"),
    )
    users = t["users"].select(F.col("id").alias("user_id"), "username")
    return top(per_user.join(users, "user_id"), n, "total_revenue", "user_id").select(
        "user_id", "username", "total_orders", "total_revenue", "total_discounted_revenue", mean_of("total", "avg_order_value")
    )


def orders_by_day(t: Tables, first: str, last: str) -> DataFrame:
    """Orders per day between two bounds (a bare date is its midnight), with the top category of the day."""
    low, high = F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")
    day = F.to_date("order_date").alias("order_day")
    in_range = t["orders"].filter(F.col("order_date").between(low, high))
    daily = in_range.groupBy(day).agg(
        F.count("id").alias("orders_count"), total("total_quantity", "total_items_sold"), total("total", "daily_revenue"),
        total("discounted_total", "daily_discounted_revenue"), *mean_parts("total"),
    )
    # a day counts whole for its top category, also past the upper bound
    whole_days = t["orders"].filter(
        (F.col("order_date") >= F.date_trunc("day", low)) & (F.col("order_date") < F.date_trunc("day", high) + F.expr("interval 1 day"))
    ).select(F.col("id").alias("order_id"), day)
    sold = t["order_items"].select("order_id", "product_id").join(whole_days, "order_id")
    per_product = sold.groupBy("order_day", "product_id").agg(F.count("*").alias("_n"))
    names = t["products"].select(F.col("id").alias("product_id"), "category_id").join(
        t["categories"].select(F.col("id").alias("category_id"), F.col("name").alias("category")), "category_id"
    ).select("product_id", "category")
    per_category = per_product.join(names, "product_id").groupBy("order_day", "category").agg(F.sum("_n").alias("_n"))
    tops = best("order_day", "category", "_n", per_category, "top_category")
    return daily.join(tops, "order_day", "left").orderBy(F.col("order_day").desc()).select(
        F.col("order_day").alias("order_date"), "orders_count", "total_items_sold", "daily_revenue",
        "daily_discounted_revenue", mean_of("total", "avg_order_value"), "top_category",
    )


def revenue_by_product(t: Tables, n: int = 50) -> DataFrame:
    per_product = t["order_items"].groupBy("product_id").agg(
        distinct("order_id", "total_orders"), total("quantity", "total_quantity"), total("total", "total_revenue")
    )
    products = t["products"].select(F.col("id").alias("product_id"), "title", "brand", "category_id")
    rows = top(per_product.join(products, "product_id"), n, "total_revenue", "product_id")
    categories = t["categories"].select(F.col("id").alias("category_id"), F.col("name").alias("category"))
    return ranked(rows.join(categories, "category_id", "left"), "total_revenue", "product_id").select(
        F.col("product_id").alias("id"), "title", "category", "brand", "total_orders", "total_quantity", "total_revenue"
    )


def top_users(t: Tables, n: int = 100) -> DataFrame:
    per_user = t["orders"].groupBy("user_id").agg(F.count("id").alias("total_orders"), total("total", "lifetime_value"))
    users = t["users"].select(F.col("id").alias("user_id"), "username", _full_name())
    return top(per_user.join(users, "user_id"), n, "lifetime_value", "user_id").select(
        F.col("user_id").alias("id"), "username", "full_name", "total_orders", "lifetime_value"
    )


def monthly_revenue(t: Tables) -> DataFrame:
    month = F.date_format("order_date", "yyyy-MM").alias("month")
    return t["orders"].groupBy(month).agg(F.count("id").alias("orders_count"), total("total", "revenue")).orderBy(
        F.col("month").desc()
    )


def wide_join(t: Tables, n: int = 1000) -> DataFrame:
    """The newest order lines with the names of everything they refer to."""
    return _looked_up(t, n).select(
        "order_id", "username", "product_name", "category", "city", "quantity", F.col("item_total").alias("total")
    )


def heavy_aggregate(t: Tables) -> DataFrame:
    """Global counts and sums over all order lines; order totals count once per line, as the query is defined.

    Lines are summed per order first, so orders are counted as rows; products are counted in an aggregate of their own.
    """
    orders = t["orders"].select(F.col("id").alias("order_id"), "user_id", F.col("total").alias("_total"), "order_date").join(
        t["users"].select(F.col("id").alias("user_id")), "user_id", "left_semi"
    )
    lines = t["order_items"].select("order_id", "product_id", "quantity").join(
        t["products"].select(F.col("id").alias("product_id")), "product_id", "left_semi"
    )
    per_order = lines.groupBy("order_id").agg(F.count("*").alias("_lines"), total("quantity", "_quantity")).join(orders, "order_id")
    products = lines.select("order_id", "product_id").join(orders.select("order_id"), "order_id", "left_semi").agg(
        distinct("product_id", "n")
    )
    return per_order.agg(
        F.count("*").alias("total_orders"), distinct("user_id", "unique_customers"), total("_quantity", "total_items"),
        F.sum(F.col("_total") * F.col("_lines")).alias("total_revenue"),
        F.sum(F.when(F.col("_total").isNotNull(), F.col("_lines"))).alias("_priced"),
        F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order"),
    ).select(
        "total_orders", "unique_customers", products.scalar().alias("unique_products"), "total_items", "total_revenue",
        mean_money("total_revenue", "_priced").alias("avg_order_value"), "first_order", "last_order",
    )


def heavy_aggregate_per_order(t: Tables) -> DataFrame:
    """Order count and value with every order counted once."""
    return t["orders"].agg(F.count("id").alias("total_orders"), total("total", "total_revenue"), *mean_parts("total")).select(
        "total_orders", "total_revenue", mean_of("total", "avg_order_value")
    )


def filtered_products(t: Tables, n: int = 20) -> DataFrame:
    """Products above a price and a stock, with the category name."""
    hits = t["products"].filter("price > 50 AND stock > 10")
    categories = t["categories"].select(F.col("id").alias("category_id"), F.col("name").alias("category_name"))
    return hits.join(categories, "category_id").orderBy("id").limit(n).select("id", "title", "price", "stock", "brand", "category_name")


def filtered_documents(products: DataFrame, n: int = 20) -> DataFrame:
    """The same filter on product documents."""
    return products.filter((F.col("price") > 50) & (F.col("stock") > 10)).orderBy("_id").limit(n).select(
        "_id", "title", "price", "stock", "brand", F.col("category.name").alias("category_name")
    )
