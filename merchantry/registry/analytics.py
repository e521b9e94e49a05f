"""The named analytic queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from merchantry.operators.dimensions import build_star
from merchantry.plans import models, relational, snowy, starry
from merchantry.registry.base import answer, mean, percent, register

NAME = "first_name || ' ' || last_name"

WIDE_3NF = f"""
    SELECT o.id AS order_id, o.order_date, o.status, o.total, o.discounted_total, u.username, u.email, {NAME} AS full_name,
        a.city, a.state, a.postal_code, i.quantity, i.price AS unit_price, i.total AS item_total, p.title AS product_name,
        p.brand, c.name AS category
    FROM t_orders o JOIN t_users u ON o.user_id = u.id LEFT JOIN t_addresses a ON u.address_id = a.id
    JOIN t_items i ON o.id = i.order_id JOIN t_products p ON i.product_id = p.id LEFT JOIN t_categories c ON p.category_id = c.id
    ORDER BY o.order_date DESC, o.id, i.id"""


@register("q_3nf_1_order_lines", answer(
    "order_id order_date:ts status total:d discounted_total:d username email full_name city state postal_code quantity:i "
    "unit_price:d item_total:d product_name brand category", f"{WIDE_3NF} LIMIT 100"))
def _(spark, sf):
    return relational.order_lines(models.normalized(spark, sf))


@register("q_3nf_2_revenue_by_user", answer(
    "user_id username full_name email city state total_orders:i total_items:i total_quantity:i total_revenue:d "
    "total_discounted_revenue:d avg_order_value:d first_order_date:ts last_order_date:ts", f"""
    SELECT u.id AS user_id, u.username, {NAME} AS full_name, u.email, a.city, a.state, count(DISTINCT o.id) AS total_orders,
        count(i.id) AS total_items, sum(i.quantity) AS total_quantity, sum(i.total) AS total_revenue,
        sum(o.discounted_total) AS total_discounted_revenue, {mean("sum(o.total)", "count(o.total)")} AS avg_order_value,
        min(o.order_date) AS first_order_date, max(o.order_date) AS last_order_date
    FROM t_users u LEFT JOIN t_addresses a ON u.address_id = a.id JOIN t_orders o ON u.id = o.user_id
    JOIN t_items i ON o.id = i.order_id
    GROUP BY u.id, u.username, first_name, last_name, u.email, a.city, a.state ORDER BY total_revenue DESC, u.id LIMIT 50"""))
def _(spark, sf):
    return relational.revenue_by_user(models.normalized(spark, sf))


@register("q_3nf_2_revenue_by_user_per_order", answer(
    "user_id username total_orders:i total_revenue:d total_discounted_revenue:d avg_order_value:d", f"""
    SELECT u.id AS user_id, u.username, count(*) AS total_orders, sum(o.total) AS total_revenue,
        sum(o.discounted_total) AS total_discounted_revenue, {mean("sum(o.total)", "count(o.total)")} AS avg_order_value
    FROM t_users u JOIN t_orders o ON u.id = o.user_id GROUP BY u.id, u.username ORDER BY total_revenue DESC, u.id LIMIT 50"""))
def _(spark, sf):
    return relational.revenue_by_user_per_order(models.normalized(spark, sf))


@register("q_3nf_3_orders_by_day", answer(
    "order_date:day orders_count:i total_items_sold:i daily_revenue:d daily_discounted_revenue:d avg_order_value:d top_category", f"""
    SELECT d.*, c.top_category FROM (
        SELECT CAST(order_date AS DATE) AS order_date, count(DISTINCT id) AS orders_count, sum(total_quantity) AS total_items_sold,
            sum(total) AS daily_revenue, sum(discounted_total) AS daily_discounted_revenue,
            {mean("sum(total)", "count(total)")} AS avg_order_value
        FROM t_orders WHERE order_date BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31'
        GROUP BY CAST(order_date AS DATE)) AS d
    LEFT JOIN (
        SELECT day, name AS top_category FROM (
            SELECT CAST(o.order_date AS DATE) AS day, c.name,
                row_number() OVER (PARTITION BY CAST(o.order_date AS DATE) ORDER BY count(*) DESC, c.name) AS rn
            FROM t_orders o JOIN t_items i ON o.id = i.order_id JOIN t_products p ON i.product_id = p.id
            JOIN t_categories c ON p.category_id = c.id GROUP BY CAST(o.order_date AS DATE), c.name) AS r WHERE rn = 1) AS c
    ON d.order_date = c.day"""))
def _(spark, sf):
    return relational.orders_by_day(models.normalized(spark, sf), "1998-01-01", "1998-12-31")


STAR_AVG = mean("sum(f.total_amount)", "count(f.total_amount)")


@register("q_star_1_revenue_by_product", answer(
    "product_id title category brand current_price:d total_orders:i total_quantity_sold:i total_subtotal:d "
    "total_discounts_given:d total_revenue:d avg_selling_price:d revenue_per_unit:d", f"""
    SELECT p.id AS product_id, p.title, p.category, p.brand, p.price AS current_price, count(DISTINCT f.order_id) AS total_orders,
        sum(f.quantity) AS total_quantity_sold, sum(f.subtotal) AS total_subtotal, sum(f.discount_amount) AS total_discounts_given,
        sum(f.total_amount) AS total_revenue, {mean("sum(f.unit_price)", "count(f.unit_price)")} AS avg_selling_price,
        {mean("sum(f.total_amount)", "sum(f.quantity)")} AS revenue_per_unit
    FROM t_fact f JOIN t_sprod p ON f.product_id = p.id GROUP BY p.id, p.title, p.category, p.brand, p.price
    ORDER BY total_revenue DESC, p.id LIMIT 50"""))
def _(spark, sf):
    return starry.revenue_by_product(models.star(spark, sf))


@register("q_star_2_top_users", answer(
    "user_id username full_name email age:i gender role total_orders:i total_items_purchased:i lifetime_value:d "
    "total_discounts_received:d avg_transaction_value:d days_with_purchases:i first_purchase_date:day last_purchase_date:day", f"""
    SELECT u.id AS user_id, u.username, {NAME} AS full_name, u.email, u.age, u.gender, u.role,
        count(DISTINCT f.order_id) AS total_orders, sum(f.quantity) AS total_items_purchased, sum(f.total_amount) AS lifetime_value,
        sum(f.discount_amount) AS total_discounts_received, {STAR_AVG} AS avg_transaction_value,
        count(DISTINCT f.date_id) AS days_with_purchases, min(d.full_date) AS first_purchase_date, max(d.full_date) AS last_purchase_date
    FROM t_fact f JOIN t_users u ON f.user_id = u.id JOIN t_dates d ON f.date_id = d.date_id
    GROUP BY ALL ORDER BY lifetime_value DESC, u.id LIMIT 100"""))
def _(spark, sf):
    return starry.top_users(models.star(spark, sf))


@register("q_star_3a_daily_revenue", answer(
    "full_date:day day_name is_weekend orders_count:i items_sold:i daily_revenue:d avg_order_value:d", f"""
    SELECT d.full_date, d.day_name, d.is_weekend, count(DISTINCT f.order_id) AS orders_count, sum(f.quantity) AS items_sold,
        sum(f.total_amount) AS daily_revenue, {STAR_AVG} AS avg_order_value
    FROM t_fact f JOIN t_dates d ON f.date_id = d.date_id GROUP BY ALL ORDER BY d.full_date DESC LIMIT 30"""))
def _(spark, sf):
    return starry.daily_revenue(models.star(spark, sf))


@register("q_star_3b_weekly_revenue", answer(
    "year:i week_of_year:i week_start:day week_end:day orders_count:i items_sold:i weekly_revenue:d avg_order_value:d", f"""
    SELECT d.year, d.week_of_year, min(d.full_date) AS week_start, max(d.full_date) AS week_end,
        count(DISTINCT f.order_id) AS orders_count, sum(f.quantity) AS items_sold, sum(f.total_amount) AS weekly_revenue,
        {STAR_AVG} AS avg_order_value
    FROM t_fact f JOIN t_dates d ON f.date_id = d.date_id GROUP BY d.year, d.week_of_year
    ORDER BY d.year DESC, d.week_of_year DESC LIMIT 20"""))
def _(spark, sf):
    return starry.weekly_revenue(models.star(spark, sf))


@register("q_star_3c_monthly_growth", answer(
    "year:i month:i month_name quarter:i orders_count:i unique_customers:i items_sold:i monthly_revenue:d total_discounts:d "
    "avg_order_value:d prev_month_revenue:d revenue_growth_percent:d", f"""
    SELECT *, {percent("monthly_revenue - prev_month_revenue", "prev_month_revenue")} AS revenue_growth_percent FROM (
        SELECT *, lag(monthly_revenue) OVER (ORDER BY year, month) AS prev_month_revenue FROM (
            SELECT d.year, d.month, d.month_name, d.quarter, count(DISTINCT f.order_id) AS orders_count,
                count(DISTINCT f.user_id) AS unique_customers, sum(f.quantity) AS items_sold,
                sum(f.total_amount) AS monthly_revenue, sum(f.discount_amount) AS total_discounts, {STAR_AVG} AS avg_order_value
            FROM t_fact f JOIN t_dates d ON f.date_id = d.date_id GROUP BY d.year, d.month, d.month_name, d.quarter) AS m) AS g"""))
def _(spark, sf):
    return starry.monthly_growth(models.star(spark, sf))


@register("q_star_4a_revenue_by_location", answer(
    "country region state city orders_count:i unique_customers:i items_sold:i total_revenue:d avg_order_value:d revenue_per_customer:d", f"""
    SELECT l.country, l.region, l.state, l.city, count(DISTINCT f.order_id) AS orders_count,
        count(DISTINCT f.user_id) AS unique_customers, sum(f.quantity) AS items_sold, sum(f.total_amount) AS total_revenue,
        {STAR_AVG} AS avg_order_value, {mean("sum(f.total_amount)", "count(DISTINCT f.user_id)")} AS revenue_per_customer
    FROM t_fact f JOIN t_locations l ON f.location_id = l.location_id GROUP BY l.country, l.region, l.state, l.city
    ORDER BY total_revenue DESC, l.country, l.region, l.state, l.city LIMIT 100"""))
def _(spark, sf):
    return starry.revenue_by_location(models.star(spark, sf))


@register("q_star_4b_revenue_by_region", answer(
    "region states_count:i cities_count:i unique_customers:i regional_revenue:d avg_order_value:d", f"""
    SELECT l.region, count(DISTINCT l.state) AS states_count, count(DISTINCT l.city) AS cities_count,
        count(DISTINCT f.user_id) AS unique_customers, sum(f.total_amount) AS regional_revenue, {STAR_AVG} AS avg_order_value
    FROM t_fact f JOIN t_locations l ON f.location_id = l.location_id GROUP BY l.region"""))
def _(spark, sf):
    return starry.revenue_by_region(models.star(spark, sf))


@register("q_star_5_category_performance", answer(
    "category products_in_category:i orders_count:i total_quantity_sold:i total_revenue:d total_discounts:d avg_product_price:d "
    "avg_transaction_value:d top_brand", f"""
    SELECT s.*, b.brand AS top_brand FROM (
        SELECT p.category, count(DISTINCT p.id) AS products_in_category, count(DISTINCT f.order_id) AS orders_count,
            sum(f.quantity) AS total_quantity_sold, sum(f.total_amount) AS total_revenue, sum(f.discount_amount) AS total_discounts,
            {mean("sum(f.unit_price)", "count(f.unit_price)")} AS avg_product_price, {STAR_AVG} AS avg_transaction_value
        FROM t_fact f JOIN t_sprod p ON f.product_id = p.id GROUP BY p.category) AS s
    LEFT JOIN (SELECT category, brand FROM (
        SELECT p.category, p.brand, row_number() OVER (PARTITION BY p.category ORDER BY sum(f.total_amount) DESC, p.brand) AS rn
        FROM t_fact f JOIN t_sprod p ON f.product_id = p.id GROUP BY p.category, p.brand) AS r WHERE rn = 1) AS b
    ON s.category = b.category"""))
def _(spark, sf):
    return starry.category_performance(models.star(spark, sf))


@register("q_snow_1_revenue_by_product", answer(
    "product_id title category_name category_slug parent_category:s brand_name brand_country:s total_orders:i "
    "total_quantity_sold:i total_revenue:d total_discounts:d avg_selling_price:d", f"""
    SELECT p.id AS product_id, p.title, c.name AS category_name, c.slug AS category_slug, NULL AS parent_category, b.brand_name,
        b.brand_country, count(DISTINCT f.order_id) AS total_orders, sum(f.quantity) AS total_quantity_sold,
        sum(f.total_amount) AS total_revenue, sum(f.discount_amount) AS total_discounts,
        {mean("sum(f.unit_price)", "count(f.unit_price)")} AS avg_selling_price
    FROM t_fact f JOIN t_snowprod p ON f.product_id = p.id LEFT JOIN t_categories c ON p.category_id = c.id
    LEFT JOIN t_brands b ON p.brand_id = b.brand_id
    GROUP BY p.id, p.title, c.name, c.slug, b.brand_name, b.brand_country ORDER BY total_revenue DESC, p.id LIMIT 50"""))
def _(spark, sf):
    return snowy.revenue_by_product(models.snowflake(spark, sf))


@register("q_snow_2_top_users", answer(
    "user_id username full_name email age:i role_name role_description city_name city_population:i state_name state_code region "
    "country total_orders:i total_items:i lifetime_value:d avg_order_value:d", f"""
    SELECT u.id AS user_id, u.username, {NAME} AS full_name, u.email, u.age, r.role_name, r.role_description, g.city_name,
        g.population AS city_population, g.state_name, g.state_code, g.region, g.country, count(DISTINCT f.order_id) AS total_orders,
        sum(f.quantity) AS total_items, sum(f.total_amount) AS lifetime_value, {STAR_AVG} AS avg_order_value
    FROM t_fact f JOIN t_snowusers u ON f.user_id = u.id LEFT JOIN t_roles r ON u.role_id = r.role_id
    LEFT JOIN t_geo g ON u.city_id = g.city_id GROUP BY ALL ORDER BY lifetime_value DESC, u.id LIMIT 100"""))
def _(spark, sf):
    return snowy.top_users(models.snowflake(spark, sf))


GEO_JOIN = "t_fact f JOIN t_snowusers u ON f.user_id = u.id LEFT JOIN t_geo g ON u.city_id = g.city_id"


@register("q_snow_3a_revenue_by_region", answer(
    "region country states_in_region:i cities_in_region:i customers_in_region:i total_orders:i regional_revenue:d avg_order_value:d", f"""
    SELECT g.region, g.country, count(DISTINCT g.state_id) AS states_in_region, count(DISTINCT g.city_id) AS cities_in_region,
        count(DISTINCT u.id) AS customers_in_region, count(DISTINCT f.order_id) AS total_orders,
        sum(f.total_amount) AS regional_revenue, {STAR_AVG} AS avg_order_value
    FROM {GEO_JOIN} GROUP BY g.region, g.country"""))
def _(spark, sf):
    return snowy.revenue_by_region(models.snowflake(spark, sf))


@register("q_snow_3b_revenue_by_state", answer(
    "state_name state_code region cities_in_state:i customers_in_state:i total_orders:i state_revenue:d avg_order_value:d", f"""
    SELECT g.state_name, g.state_code, g.region, count(DISTINCT g.city_id) AS cities_in_state,
        count(DISTINCT u.id) AS customers_in_state, count(DISTINCT f.order_id) AS total_orders, sum(f.total_amount) AS state_revenue,
        {STAR_AVG} AS avg_order_value
    FROM {GEO_JOIN} WHERE g.state_name IS NOT NULL GROUP BY g.state_name, g.state_code, g.region
    ORDER BY state_revenue DESC, g.state_code LIMIT 50"""))
def _(spark, sf):
    return snowy.revenue_by_state(models.snowflake(spark, sf))


@register("q_snow_3c_revenue_by_city", answer(
    "city_name state_name state_code region population:i customers_in_city:i total_orders:i city_revenue:d avg_order_value:d", f"""
    SELECT g.city_name, g.state_name, g.state_code, g.region, g.population, count(DISTINCT u.id) AS customers_in_city,
        count(DISTINCT f.order_id) AS total_orders, sum(f.total_amount) AS city_revenue, {STAR_AVG} AS avg_order_value
    FROM {GEO_JOIN} WHERE g.city_name IS NOT NULL GROUP BY g.city_name, g.state_name, g.state_code, g.region, g.population
    ORDER BY city_revenue DESC, g.city_name, g.state_code LIMIT 100"""))
def _(spark, sf):
    return snowy.revenue_by_city(models.snowflake(spark, sf))


@register("q_snow_4_category_performance", answer(
    "category_name category_slug parent_category:s products_count:i orders_count:i total_quantity_sold:i total_revenue:d "
    "avg_product_price:d market_share_percent:d top_brand", f"""
    SELECT s.*, {percent("total_revenue", "whole")} AS market_share_percent, b.brand_name AS top_brand FROM (
        SELECT c.id, c.name AS category_name, c.slug AS category_slug, NULL AS parent_category,
            count(DISTINCT p.id) AS products_count, count(DISTINCT f.order_id) AS orders_count,
            sum(f.quantity) AS total_quantity_sold, sum(f.total_amount) AS total_revenue,
            {mean("sum(f.unit_price)", "count(f.unit_price)")} AS avg_product_price, sum(sum(f.total_amount)) OVER () AS whole
        FROM t_fact f JOIN t_snowprod p ON f.product_id = p.id JOIN t_categories c ON p.category_id = c.id
        GROUP BY c.id, c.name, c.slug) AS s
    LEFT JOIN (SELECT category_id, brand_name FROM (
        SELECT p.category_id, b.brand_name,
            row_number() OVER (PARTITION BY p.category_id ORDER BY sum(f.total_amount) DESC, b.brand_name) AS rn
        FROM t_fact f JOIN t_snowprod p ON f.product_id = p.id JOIN t_brands b ON p.brand_id = b.brand_id
        GROUP BY p.category_id, b.brand_name) AS r WHERE rn = 1) AS b ON s.id = b.category_id"""))
def _(spark, sf):
    return snowy.category_performance(models.snowflake(spark, sf))


@register("q_bm_1_revenue_by_product_3nf", answer("id title category brand total_orders:i total_quantity:i total_revenue:d", """
    SELECT p.id, p.title, c.name AS category, p.brand, count(DISTINCT i.order_id) AS total_orders, sum(i.quantity) AS total_quantity,
        sum(i.total) AS total_revenue
    FROM t_products p LEFT JOIN t_categories c ON p.category_id = c.id JOIN t_items i ON p.id = i.product_id
    GROUP BY p.id, p.title, c.name, p.brand ORDER BY total_revenue DESC, p.id LIMIT 50"""))
def _(spark, sf):
    return relational.revenue_by_product(models.normalized(spark, sf))


@register("q_bm_1_revenue_by_product_star", answer("product_id title category brand total_orders:i total_quantity:i total_revenue:d", """
    SELECT p.id AS product_id, p.title, p.category, p.brand, count(DISTINCT f.order_id) AS total_orders,
        sum(f.quantity) AS total_quantity, sum(f.total_amount) AS total_revenue
    FROM t_fact f JOIN t_sprod p ON f.product_id = p.id GROUP BY ALL ORDER BY total_revenue DESC, p.id LIMIT 50"""))
def _(spark, sf):
    return starry.product_ranking(models.star(spark, sf))


@register("q_bm_1_revenue_by_product_snow", answer(
    "product_id title category_name brand_name total_orders:i total_quantity:i total_revenue:d", """
    SELECT p.id AS product_id, p.title, c.name AS category_name, b.brand_name, count(DISTINCT f.order_id) AS total_orders,
        sum(f.quantity) AS total_quantity, sum(f.total_amount) AS total_revenue
    FROM t_fact f JOIN t_snowprod p ON f.product_id = p.id LEFT JOIN t_categories c ON p.category_id = c.id
    LEFT JOIN t_brands b ON p.brand_id = b.brand_id GROUP BY ALL ORDER BY total_revenue DESC, p.id LIMIT 50"""))
def _(spark, sf):
    return snowy.product_ranking(models.snowflake(spark, sf))


@register("q_bm_2_top_users_3nf", answer("id username full_name total_orders:i lifetime_value:d", f"""
    SELECT u.id, u.username, {NAME} AS full_name, count(DISTINCT o.id) AS total_orders, sum(o.total) AS lifetime_value
    FROM t_users u JOIN t_orders o ON u.id = o.user_id GROUP BY u.id, u.username, first_name, last_name
    ORDER BY lifetime_value DESC, u.id LIMIT 100"""))
def _(spark, sf):
    return relational.top_users(models.normalized(spark, sf))


TOP_USERS = answer("user_id username full_name total_orders:i lifetime_value:d", f"""
    SELECT u.id AS user_id, u.username, {NAME} AS full_name, count(DISTINCT f.order_id) AS total_orders,
        sum(f.total_amount) AS lifetime_value
    FROM t_fact f JOIN t_users u ON f.user_id = u.id GROUP BY ALL ORDER BY lifetime_value DESC, u.id LIMIT 100""")


@register("q_bm_2_top_users_star", TOP_USERS)
def _(spark, sf):
    return starry.user_ranking(models.star(spark, sf))


@register("q_bm_2_top_users_snow", TOP_USERS)
def _(spark, sf):
    return starry.user_ranking(models.snowflake(spark, sf))


@register("q_bm_3_monthly_revenue_3nf", answer("month orders_count:i revenue:d", """
    SELECT strftime(order_date, '%Y-%m') AS month, count(DISTINCT id) AS orders_count, sum(total) AS revenue
    FROM t_orders GROUP BY strftime(order_date, '%Y-%m')"""))
def _(spark, sf):
    return relational.monthly_revenue(models.normalized(spark, sf))


MONTHLY = answer("year:i month:i month_name orders_count:i revenue:d", """
    SELECT d.year, d.month, d.month_name, count(DISTINCT f.order_id) AS orders_count, sum(f.total_amount) AS revenue
    FROM t_fact f JOIN t_dates d ON f.date_id = d.date_id GROUP BY d.year, d.month, d.month_name""")


@register("q_bm_3_monthly_revenue_star", MONTHLY)
def _(spark, sf):
    return starry.monthly_revenue(models.star(spark, sf))


OTHER_YEARS = """
    SELECT year(day_) AS year, month(day_) AS month, monthname(day_) AS month_name, count(*) AS orders_count, sum(amount) AS revenue FROM (
        SELECT order_id, sum(total_amount) AS amount,
            any_value(CASE WHEN order_id % 2 = 0 THEN order_date + INTERVAL 10 YEAR ELSE order_date END) AS day_
        FROM t_fact f JOIN t_orders o ON f.order_id = o.id GROUP BY order_id) AS moved GROUP BY 1, 2, 3"""


@register("q_bm_3_monthly_revenue_other_years", answer("year:i month:i month_name orders_count:i revenue:d", OTHER_YEARS))
def _(spark, sf):
    """Every second order lies ten years later; the calendar follows the orders, and none is lost."""
    tables = dict(models.normalized(spark, sf))
    later = F.when(F.col("id") % 2 == 0, F.add_months("order_date", 120).cast("timestamp_ntz")).otherwise(F.col("order_date"))
    tables["orders"] = tables["orders"].withColumn("order_date", later)
    return starry.monthly_revenue(build_star(tables))


@register("q_bm_3_monthly_revenue_snow", MONTHLY)
def _(spark, sf):
    return starry.monthly_revenue(models.snowflake(spark, sf))


@register("q_bm_4_wide_join_3nf", answer(
    "order_id username product_name category city quantity:i total:d",
    f"SELECT order_id, username, product_name, category, city, quantity, item_total AS total FROM ({WIDE_3NF} LIMIT 1000) AS w"))
def _(spark, sf):
    return relational.wide_join(models.normalized(spark, sf))


@register("q_bm_4_wide_join_star", answer("order_id username product_name category city quantity:i total_amount:d", """
    SELECT f.order_id, u.username, p.title AS product_name, p.category, l.city, f.quantity, f.total_amount
    FROM t_fact f JOIN t_users u ON f.user_id = u.id JOIN t_sprod p ON f.product_id = p.id JOIN t_dates d ON f.date_id = d.date_id
    LEFT JOIN t_locations l ON f.location_id = l.location_id ORDER BY d.full_date DESC, f.fact_id LIMIT 1000"""))
def _(spark, sf):
    return starry.wide_join(models.star(spark, sf))


@register("q_bm_4_wide_join_snow", answer("order_id username product_name category_name city_name quantity:i total_amount:d", """
    SELECT f.order_id, u.username, p.title AS product_name, c.name AS category_name, ci.city_name, f.quantity, f.total_amount
    FROM t_fact f JOIN t_snowusers u ON f.user_id = u.id JOIN t_snowprod p ON f.product_id = p.id
    LEFT JOIN t_categories c ON p.category_id = c.id LEFT JOIN t_cities ci ON u.city_id = ci.city_id
    JOIN t_dates d ON f.date_id = d.date_id ORDER BY d.full_date DESC, f.fact_id LIMIT 1000"""))
def _(spark, sf):
    return snowy.wide_join(models.snowflake(spark, sf))


@register("q_bm_5_heavy_aggregate_3nf", answer(
    "total_orders:i unique_customers:i unique_products:i total_items:i total_revenue:d avg_order_value:d first_order:ts last_order:ts", f"""
    SELECT count(DISTINCT o.id) AS total_orders, count(DISTINCT u.id) AS unique_customers, count(DISTINCT p.id) AS unique_products,
        sum(i.quantity) AS total_items, sum(o.total) AS total_revenue, {mean("sum(o.total)", "count(o.total)")} AS avg_order_value,
        min(o.order_date) AS first_order, max(o.order_date) AS last_order
    FROM t_orders o JOIN t_users u ON o.user_id = u.id JOIN t_items i ON o.id = i.order_id JOIN t_products p ON i.product_id = p.id"""))
def _(spark, sf):
    return relational.heavy_aggregate(models.normalized(spark, sf))


@register("q_bm_5_heavy_aggregate_3nf_per_order", answer("total_orders:i total_revenue:d avg_order_value:d", f"""
    SELECT count(*) AS total_orders, sum(total) AS total_revenue, {mean("sum(total)", "count(total)")} AS avg_order_value FROM t_orders"""))
def _(spark, sf):
    return relational.heavy_aggregate_per_order(models.normalized(spark, sf))


HEAVY = answer(
    "total_orders:i unique_customers:i unique_products:i total_items:i total_revenue:d avg_order_value:d first_order:day last_order:day", f"""
    SELECT count(DISTINCT f.order_id) AS total_orders, count(DISTINCT f.user_id) AS unique_customers,
        count(DISTINCT f.product_id) AS unique_products, sum(f.quantity) AS total_items, sum(f.total_amount) AS total_revenue,
        {STAR_AVG} AS avg_order_value, min(d.full_date) AS first_order, max(d.full_date) AS last_order
    FROM t_fact f JOIN t_dates d ON f.date_id = d.date_id""")


@register("q_bm_5_heavy_aggregate_star", HEAVY)
def _(spark, sf):
    return starry.heavy_aggregate(models.star(spark, sf))


@register("q_bm_5_heavy_aggregate_snow", HEAVY)
def _(spark, sf):
    return starry.heavy_aggregate(models.snowflake(spark, sf))


@register("q_bm_6_filtered_products", answer("id title price:d stock:i brand category_name", """
    SELECT p.id, p.title, p.price, p.stock, p.brand, c.name AS category_name FROM t_products p JOIN t_categories c ON p.category_id = c.id
    WHERE p.price > 50 AND p.stock > 10 ORDER BY p.id LIMIT 20"""))
def _(spark, sf):
    return relational.filtered_products(models.normalized(spark, sf))


@register("q_bm_6_filtered_documents", answer("_id title price:d stock:i brand category_name", """
    SELECT p.id AS _id, p.title, p.price, p.stock, p.brand, c.name AS category_name FROM t_products p
    JOIN t_categories c ON p.category_id = c.id WHERE p.price > 50 AND p.stock > 10 ORDER BY p.id LIMIT 20"""))
def _(spark, sf):
    return relational.filtered_documents(models.collections(spark, sf)["products"])
