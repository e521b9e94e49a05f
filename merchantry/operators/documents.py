"""Flat tables to nested documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Children:
    """Rows to embed: whole-number ``order`` columns, the last one unique, and the column with the element."""

    df: DataFrame
    parent: str
    order: list[str]
    value: str


def _block_of(children: Children, limit: int) -> list[Column]:
    *leading, last = children.order
    blocks = [F.col(c) for c in leading] + [F.call_function("div", F.col(last).cast("bigint"), F.lit(limit).cast("bigint"))]
    return [b.alias(f"_block{i}") for i, b in enumerate(blocks)]


def _with_parts(children: Children, limit: int) -> DataFrame:
    """Children with the number of the document part they belong to: whole blocks of at most ``limit``, in order, are dealt to parts."""
    df = children.df.filter(F.col(children.parent).isNotNull()).select("*", *_block_of(children, limit))
    names = [c for c in df.columns if c.startswith("_block")]
    counts = df.groupBy(children.parent, *names).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(children.parent).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    part = F.call_function("div", F.coalesce(F.sum("_n").over(earlier), F.lit(0)), F.lit(limit)).cast("int")
    return df.join(counts.select(children.parent, *names, part.alias("_part")), [children.parent, *names])


def embed(heads: DataFrame, key: str, lists: dict[str, Children], limit: int | None = None) -> DataFrame:
    """Add each child table to ``heads`` as a sorted array; a head without children gets an empty array.

    One document per head, and heads and children meet in one shuffle. For parents with more children than a
    task can hold pass a ``limit``: a head with more then continues in further rows with the same key, the
    next number in the column ``part`` (0 in the first row), null head columns and the next slice of the array.
    """
    rest = [c for c in heads.columns if c != key]
    placed = {name: c.df.withColumn("_part", F.lit(0)) if limit is None else _with_parts(c, limit) for name, c in lists.items()}
    slots = {
        name: F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(c.order)], F.col(c.value).alias("_value"))
        for name, c in lists.items()
    }
    types = {name: placed[name].select(slots[name].alias("s")).schema["s"].dataType for name in lists}
    head = F.struct(F.lit(True).alias("_present"), *rest)
    head_type = heads.select(head.alias("s")).schema["s"].dataType

    def row(df: DataFrame, key_column: str, part: Column, filled: str | None) -> DataFrame:
        columns = [head.alias("_head") if filled is None else F.lit(None).cast(head_type).alias("_head")]
        for name in lists:
            value = slots[name] if name == filled else F.lit(None).cast(types[name])
            columns.append(value.alias(f"_in_{name}"))
        return df.select(F.col(key_column).alias(key), part.alias("part"), *columns)

    rows = row(heads, key, F.lit(0), None)
    for name, c in lists.items():
        rows = rows.unionByName(row(placed[name], c.parent, F.col("_part"), name))
    by = [key] if limit is None else [key, "part"]
    grouped = rows.groupBy(*by).agg(
        F.first("_head", ignorenulls=True).alias("_head"),
        *[F.array_sort(F.collect_list(f"_in_{name}")).alias(f"_in_{name}") for name in lists],
    )
    if limit is None:
        kept = grouped.filter(F.col("_head").isNotNull())
    else:
        whole = Window.partitionBy(key)
        kept = grouped.withColumn("_known", F.max(F.col("_head").isNotNull()).over(whole)).filter("_known")
    return kept.select(
        *by, *[F.col(f"_head.{c}").alias(c) for c in rest],
        *[F.transform(f"_in_{name}", lambda x: x["_value"]).alias(name) for name in lists],
    )


def _address(prefix: str) -> Column:
    def c(name: str) -> Column:
        return F.col(f"{prefix}.{name}")
    return F.struct(
        *[c(n) for n in ("address_line", "city", "state", "state_code", "postal_code", "country")],
        F.struct(c("latitude").alias("lat"), c("longitude").alias("lng")).alias("coordinates"),
    )


USER_PLAIN = [
    "first_name", "last_name", "maiden_name", "age", "gender", "email", "phone", "username", "password", "birth_date",
    "image_url", "blood_group", "height", "weight", "eye_color", "ip_address", "mac_address", "user_agent",
    "university", "ein", "ssn", "role",
]
PRODUCT_PLAIN = [
    "title", "description", "price", "discount_percentage", "rating", "stock", "brand", "sku", "weight",
    "warranty_info", "shipping_info", "availability_status", "return_policy", "minimum_order_quantity",
]


def user_documents(t: dict[str, DataFrame]) -> DataFrame:
    """Users with their address, bank and company (and its address); an unmatched key leaves null."""
    work = t["companies"].alias("c").join(
        t["addresses"].alias("ca"), F.col("c.address_id") == F.col("ca.id"), "left"
    ).select(
        F.col("c.id").alias("company_key"),
        F.struct(
            F.col("c.name"), F.col("c.department"), F.col("c.title"),
            F.when(F.col("ca.id").isNotNull(), _address("ca")).alias("address"),
        ).alias("company"),
    )
    joined = (
        t["users"].alias("u")
        .join(t["addresses"].alias("a"), F.col("u.address_id") == F.col("a.id"), "left")
        .join(t["banks"].alias("b"), F.col("u.bank_id") == F.col("b.id"), "left")
        .join(work, F.col("u.company_id") == F.col("company_key"), "left")
    )
    bank = F.struct(*[F.col(f"b.{n}") for n in ("card_number", "card_type", "card_expire", "currency", "iban")])
    return joined.select(
        F.col("u.id").alias("_id"), *[F.col(f"u.{n}") for n in USER_PLAIN],
        F.struct(F.col("u.hair_color").alias("color"), F.col("u.hair_type").alias("type")).alias("hair"),
        F.struct(
            F.col("u.crypto_coin").alias("coin"), F.col("u.crypto_wallet").alias("wallet"),
            F.col("u.crypto_network").alias("network"),
        ).alias("crypto"),
        F.when(F.col("a.id").isNotNull(), _address("a")).alias("address"),
        F.when(F.col("b.id").isNotNull(), bank).alias("bank"),
        "company",
    )


def product_documents(t: dict[str, DataFrame], limit: int | None = None) -> DataFrame:
    """Products with category, tags, image urls by image order, and reviews."""
    category = F.struct(F.col("c.id"), F.col("c.name"), F.col("c.slug"))
    heads = (
        t["products"].alias("p")
        .join(t["categories"].alias("c"), F.col("p.category_id") == F.col("c.id"), "left")
        .select(
            F.col("p.id").alias("_id"), *[F.col(f"p.{n}") for n in PRODUCT_PLAIN],
            F.struct("p.width", "p.height", "p.depth").alias("dimensions"),
            F.struct(
                F.col("p.barcode"), F.col("p.qr_code_url").alias("qr_code"), F.col("p.created_at"), F.col("p.updated_at")
            ).alias("meta"),
            F.col("p.thumbnail_url").alias("thumbnail"),
            F.when(F.col("c.id").isNotNull(), category).alias("category"),
        )
    )
    images = t["product_images"].withColumn("image_order", F.coalesce("image_order", F.lit(0)))
    reviews = t["reviews"].select("id", "product_id", F.struct(
        "rating", "comment", "reviewer_name", "reviewer_email", F.col("review_date").alias("date")
    ).alias("review"))
    return embed(heads, "_id", {
        "tags": Children(t["product_tags"], "product_id", ["id"], "tag"),
        "images": Children(images, "product_id", ["image_order", "id"], "image_url"),
        "reviews": Children(reviews, "product_id", ["id"], "review"),
    }, limit)


def order_documents(t: dict[str, DataFrame], limit: int | None = None) -> DataFrame:
    """Orders with their user and their lines; lines of unknown products are left out."""
    heads = (
        t["orders"].alias("o").join(t["users"].alias("u"), F.col("o.user_id") == F.col("u.id"), "left")
        .select(
            F.col("o.id").alias("_id"),
            *[F.col(f"o.{n}") for n in ("order_date", "status", "total", "discounted_total", "total_products", "total_quantity")],
            F.when(F.col("u.id").isNotNull(), F.struct(
                *[F.col(f"u.{n}") for n in ("id", "username", "first_name", "last_name", "email")]
            )).alias("user"),
        )
    )
    catalog = (
        t["products"].alias("p").join(t["categories"].alias("c"), F.col("p.category_id") == F.col("c.id"), "left")
        .select(F.col("p.id").alias("product_id"), F.col("p.title"), F.col("c.name").alias("category"),
                F.col("p.thumbnail_url").alias("thumbnail"))
    )
    lines = t["order_items"].join(catalog, "product_id").select("id", "order_id", F.struct(
        "product_id", "title", "category", "price", "quantity", "total", "discount_percentage", "discounted_total",
        "thumbnail",
    ).alias("line"))
    return embed(heads, "_id", {"items": Children(lines, "order_id", ["id"], "line")}, limit)


def denormalize(t: dict[str, DataFrame], limit: int | None = None) -> dict[str, DataFrame]:
    """The three document collections."""
    return {
        "users": user_documents(t),
        "products": product_documents(t, limit),
        "orders": order_documents(t, limit),
    }
