"""Star and snowflake models from the eleven flat tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchantry import schemas
from merchantry.functions.money import line_amounts
from merchantry.functions.numbering import id_by_key
from merchantry.functions.regions import region_of
from merchantry.functions.text import display_name, non_empty, or_default
from merchantry.schemas import conform_to
from merchantry.sources.store import Keep, as_is, kept_at_once, unbroadcast

# Fixed values.
HOLIDAYS = ["01-01", "07-04", "12-25"]
ROLE_DESCRIPTIONS = {
    "user": "Regular user", "admin": "Administrator", "moderator": "Content moderator", "guest": "Guest user",
}
ROLE_SEEDS = [
    (1, "user", "Regular user"), (2, "admin", "Administrator"), (3, "moderator", "Moderator"), (4, "guest", "Guest user"),
]
OTHER_ROLE = "User role"
DEFAULT_ROLE = "user"
UNKNOWN_CATEGORY = "Unknown"
HOME_COUNTRY = "United States"
DEFAULT_STATUS = "completed"

USER_COLUMNS = [
    "username", "email", "first_name", "last_name", "age", "gender", "phone", "birth_date", "blood_group", "university",
]
PRODUCT_COLUMNS = [
    "title", "description", "brand", "sku", "price", "discount_percentage", "rating", "stock", "weight",
    "warranty_info", "availability_status",
]


def date_dimension(spark: SparkSession, first_year: int = 2020, last_year: int = 2026) -> DataFrame:
    """One row per day of the given years; fiscal years start in October."""
    return _days(spark.range(1).select(F.lit(first_year).alias("first"), F.lit(last_year).alias("last")))


def calendar_of(orders: DataFrame) -> DataFrame:
    """The date dimension of whole years from the first to the last order; empty without orders."""
    year = F.year("order_date")
    return _days(orders.agg(F.min(year).alias("first"), F.max(year).alias("last")).filter(F.col("first").isNotNull()))


def _days(years: DataFrame) -> DataFrame:
    start = F.make_date("first", F.lit(1), F.lit(1))
    end = F.make_date("last", F.lit(12), F.lit(31))
    d = F.col("full_date")
    month = F.month(d)
    return conform_to(
        years.select(F.posexplode(F.sequence(start, end)).alias("_at", "full_date")).select(
            (F.col("_at") + 1).alias("date_id"), d,
            F.year(d).alias("year"), F.quarter(d).alias("quarter"), month.alias("month"),
            F.date_format(d, "MMMM").alias("month_name"), F.dayofmonth(d).alias("day"),
            (F.weekday(d) + 1).alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"),
            F.weekofyear(d).alias("week_of_year"), (F.weekday(d) >= 5).alias("is_weekend"),
            F.date_format(d, "MM-dd").isin(HOLIDAYS).alias("is_holiday"),
            (F.year(d) + F.when(month >= 10, 1).otherwise(0)).alias("fiscal_year"),
            (F.floor(F.pmod(month - 10, F.lit(12)) / 3) + 1).alias("fiscal_quarter"),
        ),
        "star", "dim_date",
    )


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the smallest ``order`` value of each key; duplicates go before the rows are moved."""
    others = [c for c in df.columns if c not in (key, order)]
    picked = df.groupBy(key).agg(F.min_by(F.struct(order, *others), order).alias("_row"))
    return picked.select(key, "_row.*").select(*df.columns)


def _user_columns() -> list[Column]:
    return [F.col("u.id").alias("user_id"), *[F.col(f"u.{c}") for c in USER_COLUMNS],
            display_name("u.first_name", "u.last_name").alias("full_name")]


def star_users(t: dict[str, DataFrame]) -> DataFrame:
    rows = t["users"].alias("u").select(*_user_columns(), or_default("u.role", DEFAULT_ROLE).alias("role"))
    return conform_to(rows, "star", "dim_users")


def star_products(t: dict[str, DataFrame]) -> DataFrame:
    rows = t["products"].alias("p").join(
        t["categories"].select(F.col("id").alias("_category"), F.col("name").alias("_name")),
        F.col("p.category_id") == F.col("_category"), "left",
    ).select(
        F.col("p.id").alias("product_id"), *[F.col(f"p.{c}") for c in PRODUCT_COLUMNS],
        or_default("_name", UNKNOWN_CATEGORY).alias("category"),
    )
    return conform_to(rows, "star", "dim_products")


def star_locations(t: dict[str, DataFrame]) -> DataFrame:
    """One row per address, numbered in address order."""
    rows = id_by_key(t["addresses"], "id", "location_id").withColumn("region", region_of("state_code"))
    return conform_to(rows, "star", "dim_location")


PLACE = ["city", "state_code", "postal_code"]


def address_locations(addresses: DataFrame, locations: DataFrame) -> DataFrame:
    """``(address_id, location_id)``: the first location with the same city, state code and postal code."""
    firsts = locations.groupBy(*PLACE).agg(F.min("location_id").alias("location_id"))
    return unbroadcast(addresses).join(firsts, PLACE).select(F.col("id").alias("address_id"), "location_id")


def date_ids(orders: DataFrame, dates: DataFrame) -> DataFrame:
    """Orders with ``date_id``; a day outside the calendar gets its YYYYMMDD number."""
    # at most 366 rows per calendar year
    calendar = F.broadcast(dates.select(F.col("date_id").alias("_date_id"), F.col("full_date").alias("_day")))
    day = F.to_date("order_date")
    return orders.join(calendar, day == F.col("_day"), "left").withColumn(
        "date_id", F.coalesce("_date_id", F.date_format(day, "yyyyMMdd").cast("int"))
    ).drop("_date_id", "_day")


def dated_orders(t: Mapping[str, DataFrame], dates: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """What the lines of an order have in common: user, day, status and, with ``places``, the location of the user."""
    orders = date_ids(t["orders"], dates).select(
        F.col("id").alias("order_id"), "user_id", "date_id", or_default("status", DEFAULT_STATUS).alias("order_status")
    )
    return orders if places is None else orders.join(places, "user_id", "left")


def with_amounts(lines: DataFrame) -> DataFrame:
    price, quantity, pct = (or_default(c, 0) for c in ("price", "quantity", "discount_percentage"))
    others = [c for c in lines.columns if c not in ("price", "quantity", "discount_percentage")]
    return lines.select(
        *others, quantity.alias("quantity"), price.alias("unit_price"), pct.alias("discount_percentage"),
        *[c.alias(n) for n, c in line_amounts(price, quantity, pct).items()],
    )


def order_lines(t: Mapping[str, DataFrame], dates: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """One row per order line with what its order says; the line id is the fact id.

    Locations are looked up for orders, not for lines.
    """
    lines = t["order_items"].select(
        F.col("id").alias("fact_id"), "order_id", "product_id", "quantity", "price", "discount_percentage"
    )
    return lines.join(dated_orders(t, dates, places), "order_id")


def fact_lines(t: Mapping[str, DataFrame], dates: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """``order_lines`` with their amounts, which are computed after the join: lines move once, and narrow."""
    return with_amounts(order_lines(t, dates, places))


def order_totals(t: Mapping[str, DataFrame], dates: DataFrame, model: str, places: DataFrame | None = None) -> DataFrame:
    """The fact rows of each order summed, as ``plans.common.per_order`` sums them, without the fact rows: lines are summed
    before they meet their order. Orders that occur more than once count as often.
    """
    lines = conform_to(with_amounts(t["order_items"].select("order_id", "quantity", "price", "discount_percentage")), model, "fact_orders")
    sums = lines.groupBy("order_id").agg(
        F.sum("quantity").alias("_quantity"), F.sum("total_amount").alias("_amount"),
        F.count("total_amount").alias("_lines"), F.sum("discount_amount").alias("_discounts"),
    )
    attributes = ["user_id", "date_id", *(["location_id"] if places is not None else [])]
    orders = conform_to(dated_orders(t, dates, places), model, "fact_orders").select("order_id", *attributes)
    measures = [c for c in sums.columns if c != "order_id"]
    types = dict(sums.dtypes)
    return sums.join(orders, "order_id").groupBy("order_id", *attributes).agg(
        *[F.sum(c).cast(types[c]).alias(c) for c in measures]
    )


def user_places(t: Mapping[str, DataFrame], locations: DataFrame) -> DataFrame:
    """``(user_id, location_id)``: the location of the user's address."""
    return unbroadcast(t["users"].select(F.col("id").alias("user_id"), "address_id")).join(
        address_locations(t["addresses"], locations), "address_id"
    ).select("user_id", "location_id")


def star_fact(t: Mapping[str, DataFrame], dates: DataFrame, locations: DataFrame) -> DataFrame:
    """Order lines with the location of the user's address."""
    return conform_to(fact_lines(t, dates, user_places(t, locations)), "star", "fact_orders")


def _calendar(t: dict[str, DataFrame], first_year: int | None, last_year: int | None) -> DataFrame:
    if first_year is None or last_year is None:
        return calendar_of(t["orders"])
    return date_dimension(t["orders"].sparkSession, first_year, last_year)


Steps = dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]]


def star_steps(t: Mapping[str, DataFrame], first_year: int | None = None, last_year: int | None = None) -> Steps:
    """Each table of the star as a function of those before it."""
    return {
        "dim_date": lambda m: _calendar(t, first_year, last_year), "dim_location": lambda m: star_locations(t),
        "dim_users": lambda m: star_users(t), "dim_products": lambda m: star_products(t),
        "fact_orders": lambda m: star_fact(t, m["dim_date"], m["dim_location"]),
    }


def build_star(
    t: dict[str, DataFrame], first_year: int | None = None, last_year: int | None = None, keep: Keep = as_is
) -> dict[str, DataFrame]:
    """Dimensions first, then the fact table; ``keep`` may store what later tables are built from.

    The calendar has the years of the orders, or those given; orders outside given years keep a YYYYMMDD number.
    """
    steps = star_steps(t, first_year, last_year)
    first = kept_at_once(keep, {n: lambda n=n: steps[n]({}) for n in ("dim_date", "dim_location")})
    return {**first, **{n: step(first) for n, step in steps.items() if n not in first}}


def seed_roles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROLE_SEEDS, schemas.schema_of("snowflake", "dim_user_roles"))


def user_roles(users: DataFrame) -> DataFrame:
    """Roles in use, added after the four seed roles; a seed row wins over a found role of the same name."""
    role = or_default("role", DEFAULT_ROLE)
    found = (
        users.select(role.alias("role_name"), "id").filter(non_empty("role_name"))
        .groupBy("role_name").agg(F.min("id").alias("first_user"))
    )
    texts = F.create_map(*[F.lit(v) for v in chain.from_iterable(ROLE_DESCRIPTIONS.items())])
    found = found.withColumn("role_description", F.coalesce(F.try_element_at(texts, F.col("role_name")), F.lit(OTHER_ROLE)))
    seeds = seed_roles(users.sparkSession)
    added = found.join(F.broadcast(seeds.select("role_name")), "role_name", "left_anti")
    numbered = id_by_key(added, "first_user", "role_id", first=len(ROLE_SEEDS) + 1)
    return seeds.unionByName(conform_to(numbered, "snowflake", "dim_user_roles"))


def snow_categories(t: dict[str, DataFrame]) -> DataFrame:
    """Categories, unique by slug: the first row of a slug wins."""
    firsts = first_per_key(t["categories"].select("slug", "id", "name"), "slug", "id")
    rows = id_by_key(firsts, "id", "category_id").select(
        "category_id", F.col("name").alias("category_name"), F.col("slug").alias("category_slug")
    )
    return conform_to(rows, "snowflake", "dim_categories")


def snow_brands(t: dict[str, DataFrame]) -> DataFrame:
    """Brands in use, numbered by first appearance; country and website are not known."""
    firsts = (
        t["products"].filter(non_empty("brand"))
        .groupBy(F.col("brand").alias("brand_name")).agg(F.min("id").alias("first_product"))
    )
    return conform_to(id_by_key(firsts, "first_product", "brand_id"), "snowflake", "dim_brands")


def snow_states(t: dict[str, DataFrame]) -> DataFrame:
    """One row per state code: the last name seen wins, the id follows the first appearance."""
    named = t["addresses"].filter(non_empty("state_code") & non_empty("state"))
    states = named.groupBy("state_code").agg(
        F.min("id").alias("first_address"), F.max_by("state", "id").alias("state_name")
    )
    rows = id_by_key(states, "first_address", "state_id").withColumn("region", region_of("state_code"))
    return conform_to(rows, "snowflake", "dim_states")


def snow_cities(t: dict[str, DataFrame], states: DataFrame) -> DataFrame:
    """One row per city name and state."""
    named = t["addresses"].filter(non_empty("state_code") & non_empty("city"))
    firsts = (
        named.groupBy("city", "state_code").agg(F.min("id").alias("first_address"))
        .join(states.select("state_code", "state_id"), "state_code")
        .select(F.col("city").alias("city_name"), "state_id", "first_address")
    )
    return conform_to(id_by_key(firsts, "first_address", "city_id"), "snowflake", "dim_cities")


def snow_users(t: dict[str, DataFrame], roles: DataFrame, states: DataFrame, cities: DataFrame) -> DataFrame:
    """Users with role and, through their address, city."""
    places = cities.join(states.select("state_id", "state_code"), "state_id").select(
        F.col("city_name").alias("_city"), F.col("state_code").alias("_code"), "city_id"
    )
    rows = (
        t["users"].alias("u")
        .join(unbroadcast(t["addresses"]).alias("a"), F.col("u.address_id") == F.col("a.id"), "left")
        .join(places, (F.col("a.city") == F.col("_city")) & (F.col("a.state_code") == F.col("_code")), "left")
        .join(roles.alias("r"), or_default("u.role", DEFAULT_ROLE) == F.col("r.role_name"), "left")
        .select(*_user_columns(), "r.role_id", "city_id", "a.postal_code", "a.latitude", "a.longitude")
    )
    return conform_to(rows, "snowflake", "dim_users")


def snow_products(t: dict[str, DataFrame], categories: DataFrame, brands: DataFrame) -> DataFrame:
    """Products with category (by slug) and brand keys."""
    slugs = t["categories"].select(F.col("id").alias("_category"), F.col("slug").alias("category_slug")).join(
        categories.select("category_slug", F.col("category_id").alias("_category_id")), "category_slug"
    ).select("_category", "_category_id")
    rows = (
        t["products"].join(slugs, F.col("category_id") == F.col("_category"), "left")
        .join(brands.select(F.col("brand_name").alias("brand"), "brand_id"), "brand", "left")
        .select(F.col("id").alias("product_id"), F.col("_category_id").alias("category_id"), "brand_id",
                *[c for c in PRODUCT_COLUMNS if c != "brand"])
    )
    return conform_to(rows, "snowflake", "dim_products")


def snowflake_steps(t: Mapping[str, DataFrame], first_year: int | None = None, last_year: int | None = None) -> Steps:
    """Each table of the snowflake as a function of those before it."""
    return {
        "dim_user_roles": lambda m: user_roles(t["users"]), "dim_states": lambda m: snow_states(t),
        "dim_categories": lambda m: snow_categories(t), "dim_brands": lambda m: snow_brands(t),
        "dim_date": lambda m: _calendar(t, first_year, last_year), "dim_cities": lambda m: snow_cities(t, m["dim_states"]),
        "dim_users": lambda m: snow_users(t, m["dim_user_roles"], m["dim_states"], m["dim_cities"]),
        "dim_products": lambda m: snow_products(t, m["dim_categories"], m["dim_brands"]),
        "fact_orders": lambda m: conform_to(fact_lines(t, m["dim_date"]), "snowflake", "fact_orders"),
    }


def build_snowflake(
    t: dict[str, DataFrame], first_year: int | None = None, last_year: int | None = None, keep: Keep = as_is
) -> dict[str, DataFrame]:
    """Sub-dimensions, dimensions, fact table; ``keep`` may store what later tables are built from."""
    steps = snowflake_steps(t, first_year, last_year)
    alone = ("dim_user_roles", "dim_states", "dim_categories", "dim_brands", "dim_date")
    first = kept_at_once(keep, {n: lambda n=n: steps[n]({}) for n in alone})
    first["dim_cities"] = keep("dim_cities", steps["dim_cities"](first))
    return {**first, **{n: step(first) for n, step in steps.items() if n not in first}}


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` per table."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
