"""Retail entities derived from the order, customer and part tables of a data folder.

``raw_*`` give the nested entities that the normalizer reads, ``normalized`` the eleven flat tables.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchantry import schemas
from merchantry.functions.money import as_money, cents, half_up
from merchantry.functions.numbering import id_by_order
from merchantry.operators import documents, normalize
from merchantry.sources.store import Keep, Stored, lasting, once, stored

# The state code of each nation key.
NATION_STATES = "NY FL OH TX CA NY GA OH AZ WA PA FL IL TX CA MA NC MI OK CO NY GA PR NM GU".split()

LINE_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _or_null(condition: Column, value: Column) -> Column:
    return F.when(condition, value)


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested users; bank, company and the addresses are absent for low account balances."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    df = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    name, balance, nation = F.col("c_name"), F.col("c_acctbal"), F.col("n_nationkey")
    code = F.element_at(F.array(*[F.lit(c) for c in NATION_STATES]), nation + 1)
    state = F.concat("r_name", F.lit(" "), code)
    zone = (nation * 100 + F.floor(F.abs(balance) / 2500)).cast("string")
    coordinates = F.struct((nation * F.lit(1.5)).alias("lat"), (F.col("n_regionkey") * F.lit(-2.5)).alias("lng"))

    def address(line: Column, prefix: str, country: Column) -> Column:
        return F.struct(
            line.alias("address"), F.col("n_name").alias("city"), state.alias("state"), code.alias("stateCode"),
            F.concat(F.lit(prefix), zone).alias("postalCode"), country.alias("country"),
            coordinates.alias("coordinates"),
        )

    age = (F.lit(20) + F.floor(F.abs(balance) / 150)).cast("int")
    company = F.struct(
        F.concat("c_mktsegment", F.lit(" Inc")).alias("name"), F.col("r_name").alias("department"),
        F.lit("Agent").alias("title"),
        _or_null(balance > 500, address(F.concat(F.lit("HQ "), name), "9", F.lit("Canada"))).alias("address"),
    )
    nested = df.select(
        F.col("c_custkey").alias("id"),
        F.substring_index(name, "#", 1).alias("firstName"), F.substring_index(name, "#", -1).alias("lastName"),
        age.alias("age"), _or_null(nation < 20, F.lit("female")).alias("gender"),
        F.lower(F.concat(F.replace(name, F.lit("#"), F.lit(".")), F.lit("@example.com"))).alias("email"),
        F.concat(F.lit("+1-"), nation.cast("string")).alias("phone"), name.alias("username"),
        F.date_format(F.date_sub(F.lit("2000-01-01").cast("date"), age * 365), "yyyy-MM-dd").alias("birthDate"),
        (F.lit(150.0) + nation).alias("height"), (F.lit(50.0) + nation).alias("weight"),
        F.struct(F.lower("c_mktsegment").alias("color"), F.lit(None).cast("string").alias("type")).alias("hair"),
        F.col("n_name").alias("university"),
        _or_null(F.col("c_mktsegment") != "BUILDING", F.lower("c_mktsegment")).alias("role"),
        F.struct(
            F.col("r_name").alias("coin"), F.concat(F.lit("w-"), F.col("c_custkey").cast("string")).alias("wallet"),
            F.lit(None).cast("string").alias("network"),
        ).alias("crypto"),
        _or_null(balance >= 0, F.struct(
            F.col("c_custkey").cast("string").alias("cardNumber"), F.col("c_mktsegment").alias("cardType"),
            F.lit("12/30").alias("cardExpire"), F.col("r_name").alias("currency"),
            F.concat(F.lit("IB"), F.col("c_custkey").cast("string")).alias("iban"),
        )).alias("bank"),
        _or_null(balance > -800, address(F.concat(name, F.lit(" Street")), "", F.lit(None).cast("string"))).alias("address"),
        _or_null(balance > -500, company).alias("company"),
    )
    return schemas.conform(nested, schemas.struct_type(schemas.RAW["users"]))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested products with one tag per word of the name and up to three images and five reviews."""
    size, part = F.col("p_size"), F.col("p_partkey").cast("string")
    review = lambda i: F.struct(
        (F.pmod(size + i, F.lit(5)) + 1).cast("int").alias("rating"),
        F.concat("p_brand", F.lit(" review "), i.cast("string")).alias("comment"),
        F.col("p_type").alias("reviewerName"),
        F.concat(F.lower("p_type"), F.lit("@example.com")).alias("reviewerEmail"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), i.cast("int")), "yyyy-MM-dd").alias("date"),
    )
    upto = lambda n: F.filter(F.sequence(F.lit(0), n), lambda i: i > 0)
    nested = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"),
        F.concat("p_brand", F.lit(" "), F.col("p_name")).alias("description"),
        F.when(size < 25, F.col("p_type")).when(size < 50, F.lower("p_type")).alias("category"),
        F.col("p_retailprice").alias("price"), (size / 4.0).alias("discountPercentage"), (size / 10.0).alias("rating"),
        size.alias("stock"), _or_null(F.col("p_brand") != "Brand#1", F.col("p_brand")).alias("brand"),
        F.concat(F.lit("SKU-"), part).alias("sku"), size.cast("double").alias("weight"),
        _or_null(size <= 45, F.struct(
            (size / 2.0).alias("width"), (size / 4.0).alias("height"), (size / 5.0).alias("depth")
        )).alias("dimensions"),
        F.concat("p_type", F.lit(" warranty")).alias("warrantyInformation"),
        F.when(size > 10, F.lit("In Stock")).otherwise(F.lit("Low Stock")).alias("availabilityStatus"),
        (size / 10).cast("int").alias("minimumOrderQuantity"),
        F.struct(
            part.alias("barcode"), F.lit(None).cast("string").alias("qrCode"),
            F.lit("2024-01-01T08:30:00").alias("createdAt"), F.lit("2024-06-01T00:00:00").alias("updatedAt"),
        ).alias("meta"),
        F.concat(F.lit("thumb/"), part).alias("thumbnail"),
        F.split("p_name", " ").alias("tags"),
        F.transform(
            upto((size / 15).cast("int")), lambda i: F.concat(F.lit("img/"), part, F.lit("/"), i.cast("string"))
        ).alias("images"),
        F.transform(upto((size / 10).cast("int")), review).alias("reviews"),
    )
    return schemas.conform(nested, schemas.struct_type(schemas.RAW["products"]))


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items with gap-free ids in line order; the unit price is the extended price per piece.

    The ordered lines are written once; items are read from them.
    """
    return numbered_items(table(spark, sf_dir, "lineitem"))


def numbered_items(rows: DataFrame, first: int = 1) -> DataFrame:
    """Order items of these lines, with ids from ``first``."""
    return _items(id_by_order(rows, LINE_ORDER, "id", first, LINE_COLUMNS))


def plain_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items without their ids (null), for questions that do not ask for them: no line is ordered."""
    return _items(table(spark, sf_dir, "lineitem").withColumn("id", F.lit(None).cast("bigint")))


def _items(lines: DataFrame) -> DataFrame:
    quantity = F.col("l_quantity").cast("int")
    amount, rate = as_money("l_extendedprice"), as_money("l_discount", 4)
    price = half_up(cents(amount), quantity).cast("decimal(12,0)") * F.lit(Decimal("0.01"))
    items = lines.select(
        "id", F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        quantity.alias("quantity"), price.alias("price"), (rate * 100).alias("discount_percentage"),
        F.round(amount - amount * rate, 2).alias("discounted_total"), amount.alias("total"),
    )
    return schemas.conform_to(items, "normalized", "order_items")


def order_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the number of lines and pieces; 5 % off the total."""
    sizes = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("lines"), F.sum(F.col("l_quantity").cast("int")).alias("pieces")
    )
    total = as_money("o_totalprice")
    heads = table(spark, sf_dir, "orders").join(sizes, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("status"), total.alias("total"),
        F.round(total * F.lit(Decimal("0.95")), 2).alias("discounted_total"),
        F.coalesce("lines", F.lit(0)).alias("total_products"), F.coalesce("pieces", F.lit(0)).alias("total_quantity"),
    )
    return schemas.conform_to(heads, "normalized", "orders")


def order_keys(orders: DataFrame) -> DataFrame:
    """Id, user, date and status of these orders, which need no line."""
    named = orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("order_date"),
                          F.col("o_orderstatus").alias("status"))
    return schemas.conform_to(named, "normalized", "orders").select("id", "user_id", "order_date", "status")


USER_TABLES = ["addresses", "banks", "companies", "users"]
PRODUCT_TABLES = ["categories", "products", "product_tags", "product_images", "reviews"]


def normalized(spark: SparkSession, sf_dir: str) -> Stored:
    """The eleven flat tables, each stored on first use."""
    def build(keep: Keep) -> dict:
        users = once(lambda: normalize.normalize_users(raw_users(spark, sf_dir), keep))
        products = once(lambda: normalize.normalize_products(raw_products(spark, sf_dir), keep))
        return {
            **{name: lambda _, n=name: users()[n] for name in USER_TABLES},
            **{name: lambda _, n=name: products()[n] for name in PRODUCT_TABLES},
            "orders": lambda _: order_heads(spark, sf_dir),
            "order_items": lambda _: lasting(line_items(spark, sf_dir)),
        }
    return stored(spark, sf_dir, "normalized", build)


def raw_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested carts; a cart of very many lines comes in several parts (see ``documents.embed``)."""
    tables = normalized(spark, sf_dir)
    heads = tables["orders"].select(
        "id", F.col("user_id").alias("userId"), F.col("total").cast("double").alias("total"),
        F.col("discounted_total").cast("double").alias("discountedTotal"),
        F.col("total_products").alias("totalProducts"), F.col("total_quantity").alias("totalQuantity"),
    )
    lines = tables["order_items"].select(
        "id", "order_id", F.struct(
            F.col("product_id").alias("id"), "quantity", F.col("price").cast("double").alias("price"),
            F.col("discount_percentage").cast("double").alias("discountPercentage"),
            F.col("discounted_total").cast("double").alias("discountedTotal"),
            F.col("total").cast("double").alias("total"),
        ).alias("line"),
    )
    return documents.embed(heads, "id", {"products": documents.Children(lines, "order_id", ["id"], "line")})
