"""Nested users, products and carts to eleven flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchantry.functions import seeded
from merchantry.functions.numbering import id_by_key, running_total, running_totals
from merchantry.functions.text import or_default, slug
from merchantry.schemas import conform_to
from merchantry.sources.store import Keep, as_is

DEFAULT_CATEGORY = "uncategorized"
# Fixed values.
ORDER_STATUSES = ["completed", "pending", "shipped", "delivered"]

# raw field -> column, for the fields that are only renamed
USER_FIELDS = {
    "id": "id", "firstName": "first_name", "lastName": "last_name", "maidenName": "maiden_name", "age": "age",
    "gender": "gender", "email": "email", "phone": "phone", "username": "username", "password": "password",
    "birthDate": "birth_date", "image": "image_url", "bloodGroup": "blood_group", "height": "height",
    "weight": "weight", "eyeColor": "eye_color", "hair.color": "hair_color", "hair.type": "hair_type",
    "ip": "ip_address", "macAddress": "mac_address", "userAgent": "user_agent", "university": "university",
    "ein": "ein", "ssn": "ssn", "role": "role", "crypto.coin": "crypto_coin", "crypto.wallet": "crypto_wallet",
    "crypto.network": "crypto_network",
}
PRODUCT_FIELDS = {
    "id": "id", "title": "title", "description": "description", "price": "price",
    "discountPercentage": "discount_percentage", "rating": "rating", "stock": "stock", "brand": "brand",
    "sku": "sku", "weight": "weight", "dimensions.width": "width", "dimensions.height": "height",
    "dimensions.depth": "depth", "warrantyInformation": "warranty_info", "shippingInformation": "shipping_info",
    "availabilityStatus": "availability_status", "returnPolicy": "return_policy",
    "minimumOrderQuantity": "minimum_order_quantity", "meta.barcode": "barcode", "meta.qrCode": "qr_code_url",
    "thumbnail": "thumbnail_url", "meta.createdAt": "created_at", "meta.updatedAt": "updated_at",
}
CART_FIELDS = {
    "id": "id", "userId": "user_id", "total": "total", "discountedTotal": "discounted_total",
    "totalProducts": "total_products", "totalQuantity": "total_quantity",
}
ITEM_FIELDS = {
    "id": "product_id", "quantity": "quantity", "price": "price", "discountPercentage": "discount_percentage",
    "discountedTotal": "discounted_total", "total": "total",
}
REVIEW_FIELDS = {
    "rating": "rating", "comment": "comment", "reviewerName": "reviewer_name", "reviewerEmail": "reviewer_email",
    "date": "review_date",
}
BANK_FIELDS = {
    "cardNumber": "card_number", "cardType": "card_type", "cardExpire": "card_expire", "currency": "currency",
    "iban": "iban",
}
ADDRESS_FIELDS = {
    "address": "address_line", "city": "city", "state": "state", "stateCode": "state_code",
    "postalCode": "postal_code",
}


def renamed(fields: dict[str, str], parent: str = "") -> list[Column]:
    """Snake-case columns from (possibly nested) raw fields."""
    return [F.col(f"{parent}{raw}").alias(name) for raw, name in fields.items()]


def address_columns(parent: str) -> list[Column]:
    """The eight columns of an address struct; missing texts are empty, a missing country is the default."""
    texts = [or_default(f"{parent}.{raw}", "").alias(name) for raw, name in ADDRESS_FIELDS.items()]
    return texts + [
        F.col(f"{parent}.country").alias("country"),
        F.col(f"{parent}.coordinates.lat").alias("latitude"),
        F.col(f"{parent}.coordinates.lng").alias("longitude"),
    ]


def has_content(df: DataFrame, path: str) -> Column:
    """True where the struct at ``path`` is there and not all of its fields are null."""
    found = F.lit(False)
    for name in df.select(F.col(path).alias("s")).schema["s"].dataType.names:
        found = found | F.col(f"{path}.{name}").isNotNull()
    return found


def _one_if(c: Column) -> Column:
    return F.when(c, F.lit(1)).otherwise(F.lit(0))


def number_user_parts(users: DataFrame) -> DataFrame:
    """Raw users with the ids of their address, company address, bank and company; null where absent.

    Addresses share one sequence: a user's own address first, then the address of the company.
    """
    own, work = has_content(users, "address"), has_content(users, "company.address")
    bank, company = has_content(users, "bank"), has_content(users, "company")
    # three totals over the same key share one shuffle
    numbered = running_totals(users, "id", {
        "_addresses": _one_if(own) + _one_if(work), "_banks": _one_if(bank), "_companies": _one_if(company),
    })
    return (
        numbered
        .withColumn("address_id", F.when(own, F.col("_addresses") + 1))
        .withColumn("company_address_id", F.when(work, F.col("_addresses") + _one_if(own) + 1))
        .withColumn("bank_id", F.when(bank, F.col("_banks") + 1))
        .withColumn("company_id", F.when(company, F.col("_companies") + 1))
        .drop("_addresses", "_banks", "_companies")
    )


def normalize_users(users: DataFrame, keep: Keep = as_is) -> dict[str, DataFrame]:
    """Users, addresses, banks and companies; ``keep`` may store the numbered users that all four read."""
    parts = keep("user_parts", number_user_parts(users))
    own = parts.filter(F.col("address_id").isNotNull()).select(F.col("address_id").alias("id"), *address_columns("address"))
    work = parts.filter(F.col("company_address_id").isNotNull()).select(
        F.col("company_address_id").alias("id"), *address_columns("company.address")
    )
    banks = parts.filter(F.col("bank_id").isNotNull()).select(F.col("bank_id").alias("id"), *renamed(BANK_FIELDS, "bank."))
    companies = parts.filter(F.col("company_id").isNotNull()).select(
        F.col("company_id").alias("id"), or_default("company.name", "").alias("name"),
        F.col("company.department").alias("department"), F.col("company.title").alias("title"),
        F.col("company_address_id").alias("address_id"),
    )
    flat = parts.select(*renamed(USER_FIELDS), "bank_id", "company_id", "address_id")
    return {
        "addresses": conform_to(own.unionByName(work), "normalized", "addresses"),
        "banks": conform_to(banks, "normalized", "banks"),
        "companies": conform_to(companies, "normalized", "companies"),
        "users": conform_to(flat, "normalized", "users"),
    }


def categories_of(products: DataFrame) -> DataFrame:
    """One row per slug: id by first appearance, name of the first appearance."""
    name = or_default("category", DEFAULT_CATEGORY)
    firsts = (
        products.select("id", name.alias("name"), slug(name).alias("slug"))
        .groupBy("slug")
        .agg(F.min("id").alias("first_product"), F.coalesce(F.min_by("name", "id"), F.min("name")).alias("name"))
    )
    return conform_to(id_by_key(firsts, "first_product", "id"), "normalized", "categories")


def _size(array: str) -> Column:
    return F.greatest(F.coalesce(F.size(array), F.lit(0)), F.lit(0))


def _elements(parents: DataFrame, key: str, array: str, start: str, value: str) -> DataFrame:
    """``(id, parent_id, pos, value)`` per array element; the ids of a parent follow its ``start``."""
    return parents.select(F.col(key).alias("parent_id"), F.col(start).alias("_start"), F.posexplode(array).alias("pos", value)).select(
        (F.col("_start") + F.col("pos") + 1).alias("id"), "parent_id", "pos", value
    )


def exploded_with_ids(parents: DataFrame, key: str, array: str, value: str) -> DataFrame:
    """``(id, key, pos, value)`` per array element; ids run on from parent to parent in key order.

    A parent may come in several rows with a ``part`` number; its elements then run on from part to part.
    """
    if "part" not in parents.columns:
        return _elements(running_total(parents.select(key, array), key, _size(array), "_start"), key, array, "_start", value)
    # only sizes are numbered, so that the parts of one parent stay spread over the tasks
    sizes = parents.select(F.col(key).alias("_key"), F.col("part").alias("_part"), _size(array).alias("_size"))
    starts = running_total(sizes.groupBy("_key").agg(F.sum("_size").alias("_size")), "_key", F.col("_size"), "_parent_start")
    starts = starts.select(F.col("_key").alias("_parent"), "_parent_start")
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.join(starts, F.col("_key").eqNullSafe(F.col("_parent"))).select(
        "_key", "_part", "_parent_start", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_earlier")
    )
    placed = parents.select(key, "part", array).join(offsets, F.col(key).eqNullSafe(F.col("_key")) & (F.col("part") == F.col("_part")))
    return placed.select(F.col(key).alias("parent_id"), "_parent_start", "_earlier", F.posexplode(array).alias("_pos", value)).select(
        (F.col("_parent_start") + F.col("_earlier") + F.col("_pos") + 1).alias("id"), "parent_id",
        (F.col("_earlier") + F.col("_pos")).alias("pos"), value,
    )


CHILD_ARRAYS = {"tags": "tag", "images": "image_url", "reviews": "review"}


def normalize_products(products: DataFrame, keep: Keep = as_is) -> dict[str, DataFrame]:
    """Products, categories, tags, images and reviews; ``keep`` may store the numbered products that all of them read.

    The ids of the three child tables come from totals over one key that share one pass.
    """
    categories = keep("categories", categories_of(products))
    parts = keep("product_parts", running_totals(products, "id", {f"_{array}": _size(array) for array in CHILD_ARRAYS}))
    flat = (
        parts.withColumn("_slug", slug(or_default("category", DEFAULT_CATEGORY)))
        .join(categories.select(F.col("slug").alias("_slug"), F.col("id").alias("category_id")), "_slug", "left")
        .select(*renamed(PRODUCT_FIELDS), "category_id")
    )
    children = {array: _elements(parts, "id", array, f"_{array}", value) for array, value in CHILD_ARRAYS.items()}
    tags = children["tags"].withColumnRenamed("parent_id", "product_id")
    images = children["images"].withColumnsRenamed({"parent_id": "product_id", "pos": "image_order"})
    reviews = children["reviews"].select("id", F.col("parent_id").alias("product_id"), *renamed(REVIEW_FIELDS, "review."))
    return {
        "categories": categories,
        "products": conform_to(flat, "normalized", "products"),
        "product_tags": conform_to(tags, "normalized", "product_tags"),
        "product_images": conform_to(images, "normalized", "product_images"),
        "reviews": conform_to(reviews, "normalized", "reviews"),
    }


def order_date_of(key: str, anchor: str) -> Column:
    """A timestamp within the year up to the ``anchor`` date, between 9:00 and 21:59:59."""
    day = F.date_sub(F.lit(anchor).cast("date"), seeded.randint(key, "order-day", 0, 365).cast("int"))
    return F.make_timestamp_ntz(
        F.year(day), F.month(day), F.dayofmonth(day), seeded.randint(key, "order-hour", 9, 21).cast("int"),
        seeded.randint(key, "order-minute", 0, 59).cast("int"),
        seeded.randint(key, "order-second", 0, 59).cast("decimal(16,6)"),
    )


def normalize_carts(carts: DataFrame, anchor: str = "2025-12-01") -> dict[str, DataFrame]:
    """Orders and order items; order date and status are derived from the cart id."""
    heads = carts.filter(F.col("part") == 0) if "part" in carts.columns else carts
    orders = heads.select(*renamed(CART_FIELDS)).select(
        "*", order_date_of("id", anchor).alias("order_date"),
        seeded.choice("id", "order-status", ORDER_STATUSES).alias("status"),
    )
    items = exploded_with_ids(carts, "id", "products", "item").select(
        F.col("id"), F.col("parent_id").alias("order_id"), *renamed(ITEM_FIELDS, "item.")
    )
    return {
        "orders": conform_to(orders, "normalized", "orders"),
        "order_items": conform_to(items, "normalized", "order_items"),
    }


def normalize(
    users: DataFrame, products: DataFrame, carts: DataFrame, anchor: str = "2025-12-01", keep: Keep = as_is
) -> dict[str, DataFrame]:
    """All eleven tables; ``keep`` may store the numbered users and products, which are otherwise computed per table."""
    return {**normalize_users(users, keep), **normalize_products(products, keep), **normalize_carts(carts, anchor)}
