"""Declared table schemas, keys and rules of the relational, star and snowflake models."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Tables, columns, types, keys and defaults of the three models and of the raw records.
NORMALIZED = {
    "addresses": """id BIGINT NOT NULL, address_line STRING, city STRING, state STRING, state_code STRING,
        postal_code STRING, country STRING, latitude DECIMAL(10,8), longitude DECIMAL(11,8)""",
    "banks": "id BIGINT NOT NULL, card_number STRING, card_type STRING, card_expire STRING, currency STRING, iban STRING",
    "categories": "id BIGINT NOT NULL, name STRING NOT NULL, slug STRING NOT NULL",
    "companies": "id BIGINT NOT NULL, name STRING NOT NULL, department STRING, title STRING, address_id BIGINT",
    "users": """id BIGINT NOT NULL, first_name STRING, last_name STRING, maiden_name STRING, age INT, gender STRING,
        email STRING, phone STRING, username STRING, password STRING, birth_date DATE, image_url STRING,
        blood_group STRING, height DECIMAL(5,2), weight DECIMAL(5,2), eye_color STRING, hair_color STRING,
        hair_type STRING, ip_address STRING, mac_address STRING, user_agent STRING, university STRING, ein STRING,
        ssn STRING, role STRING, crypto_coin STRING, crypto_wallet STRING, crypto_network STRING, bank_id BIGINT,
        company_id BIGINT, address_id BIGINT""",
    "products": """id BIGINT NOT NULL, title STRING NOT NULL, description STRING, category_id BIGINT,
        price DECIMAL(10,2), discount_percentage DECIMAL(5,2), rating DECIMAL(3,2), stock INT, brand STRING,
        sku STRING, weight DECIMAL(10,2), width DECIMAL(10,2), height DECIMAL(10,2), depth DECIMAL(10,2),
        warranty_info STRING, shipping_info STRING, availability_status STRING, return_policy STRING,
        minimum_order_quantity INT, barcode STRING, qr_code_url STRING, thumbnail_url STRING,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "product_tags": "id BIGINT NOT NULL, product_id BIGINT, tag STRING NOT NULL",
    "product_images": "id BIGINT NOT NULL, product_id BIGINT, image_url STRING NOT NULL, image_order INT",
    "reviews": """id BIGINT NOT NULL, product_id BIGINT, rating INT, comment STRING, reviewer_name STRING,
        reviewer_email STRING, review_date TIMESTAMP_NTZ""",
    "orders": """id BIGINT NOT NULL, user_id BIGINT, order_date TIMESTAMP_NTZ NOT NULL, status STRING,
        total DECIMAL(12,2), discounted_total DECIMAL(12,2), total_products INT, total_quantity INT""",
    "order_items": """id BIGINT NOT NULL, order_id BIGINT, product_id BIGINT, quantity INT NOT NULL,
        price DECIMAL(12,2), discount_percentage DECIMAL(5,2), discounted_total DECIMAL(12,2), total DECIMAL(12,2)""",
}

# parents before children
LOAD_ORDER = [
    "addresses", "banks", "categories", "companies", "users", "products",
    "product_tags", "product_images", "reviews", "orders", "order_items",
]

DATE_DIM = """date_id INT NOT NULL, full_date DATE NOT NULL, year INT NOT NULL, quarter INT NOT NULL,
    month INT NOT NULL, month_name STRING, day INT NOT NULL, day_of_week INT NOT NULL, day_name STRING,
    week_of_year INT NOT NULL, is_weekend BOOLEAN NOT NULL, is_holiday BOOLEAN, fiscal_year INT, fiscal_quarter INT"""

USER_DIM = """user_id BIGINT NOT NULL, username STRING, email STRING, first_name STRING, last_name STRING,
    full_name STRING, age INT, gender STRING, phone STRING, birth_date DATE, blood_group STRING, university STRING"""

STAR = {
    "dim_users": USER_DIM + ", role STRING",
    "dim_products": """product_id BIGINT NOT NULL, title STRING NOT NULL, description STRING, category STRING,
        brand STRING, sku STRING, price DECIMAL(10,2), discount_percentage DECIMAL(5,2), rating DECIMAL(3,2),
        stock INT, weight DECIMAL(10,2), warranty_info STRING, availability_status STRING""",
    "dim_date": DATE_DIM,
    "dim_location": """location_id BIGINT NOT NULL, address_line STRING, city STRING, state STRING, state_code STRING,
        postal_code STRING, country STRING, region STRING, latitude DECIMAL(10,8), longitude DECIMAL(11,8)""",
    "fact_orders": """fact_id BIGINT NOT NULL, order_id BIGINT NOT NULL, user_id BIGINT, product_id BIGINT,
        date_id INT NOT NULL, location_id BIGINT, quantity INT, unit_price DECIMAL(12,2),
        discount_percentage DECIMAL(5,2), discount_amount DECIMAL(18,2), subtotal DECIMAL(18,2),
        total_amount DECIMAL(18,2), order_status STRING""",
}

SNOWFLAKE = {
    "dim_user_roles": "role_id BIGINT NOT NULL, role_name STRING NOT NULL, role_description STRING",
    "dim_categories": """category_id BIGINT NOT NULL, category_name STRING NOT NULL, category_slug STRING NOT NULL,
        parent_category_id BIGINT""",
    "dim_brands": "brand_id BIGINT NOT NULL, brand_name STRING NOT NULL, brand_country STRING, brand_website STRING",
    "dim_states": """state_id BIGINT NOT NULL, state_name STRING NOT NULL, state_code STRING NOT NULL, region STRING,
        country STRING""",
    "dim_cities": "city_id BIGINT NOT NULL, city_name STRING NOT NULL, state_id BIGINT, population INT, timezone STRING",
    "dim_users": USER_DIM + """, role_id BIGINT, city_id BIGINT, postal_code STRING, latitude DECIMAL(10,8),
        longitude DECIMAL(11,8)""",
    "dim_products": """product_id BIGINT NOT NULL, title STRING NOT NULL, description STRING, category_id BIGINT,
        brand_id BIGINT, sku STRING, price DECIMAL(10,2), discount_percentage DECIMAL(5,2), rating DECIMAL(3,2),
        stock INT, weight DECIMAL(10,2), warranty_info STRING, availability_status STRING""",
    "dim_date": DATE_DIM,
    "fact_orders": STAR["fact_orders"].replace("location_id BIGINT, ", ""),
}

MODELS = {"normalized": NORMALIZED, "star": STAR, "snowflake": SNOWFLAKE}

DEFAULTS = {
    "normalized": {
        "addresses": {"country": "United States"},
        "users": {"role": "user"},
        "product_images": {"image_order": 0},
        "orders": {"status": "pending"},
    },
    "star": {
        "dim_date": {"is_holiday": False},
        "dim_location": {"country": "United States"},
        "fact_orders": {"discount_percentage": 0, "discount_amount": 0},
    },
    "snowflake": {
        "dim_states": {"country": "United States"},
        "dim_date": {"is_holiday": False},
        "fact_orders": {"discount_percentage": 0, "discount_amount": 0},
    },
}

UNIQUE_KEYS = {
    "normalized": {**{t: [["id"]] for t in NORMALIZED}, "categories": [["id"], ["slug"]]},
    "star": {
        "dim_users": [["user_id"]], "dim_products": [["product_id"]], "dim_date": [["date_id"], ["full_date"]],
        "dim_location": [["location_id"]], "fact_orders": [["fact_id"]],
    },
    "snowflake": {
        "dim_user_roles": [["role_id"], ["role_name"]], "dim_categories": [["category_id"], ["category_slug"]],
        "dim_brands": [["brand_id"], ["brand_name"]], "dim_states": [["state_id"], ["state_code"]],
        "dim_cities": [["city_id"], ["city_name", "state_id"]], "dim_users": [["user_id"]],
        "dim_products": [["product_id"]], "dim_date": [["date_id"], ["full_date"]], "fact_orders": [["fact_id"]],
    },
}


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_column: str = "id"


FOREIGN_KEYS = {
    "normalized": [
        ForeignKey("orders", "user_id", "users"),
        ForeignKey("order_items", "order_id", "orders"),
        ForeignKey("order_items", "product_id", "products"),
        ForeignKey("users", "address_id", "addresses"),
        ForeignKey("products", "category_id", "categories"),
        ForeignKey("users", "bank_id", "banks"),
        ForeignKey("users", "company_id", "companies"),
        ForeignKey("companies", "address_id", "addresses"),
        ForeignKey("product_tags", "product_id", "products"),
        ForeignKey("product_images", "product_id", "products"),
        ForeignKey("reviews", "product_id", "products"),
    ],
    "star": [
        ForeignKey("fact_orders", "user_id", "dim_users", "user_id"),
        ForeignKey("fact_orders", "product_id", "dim_products", "product_id"),
        ForeignKey("fact_orders", "date_id", "dim_date", "date_id"),
        ForeignKey("fact_orders", "location_id", "dim_location", "location_id"),
    ],
    "snowflake": [
        ForeignKey("dim_categories", "parent_category_id", "dim_categories", "category_id"),
        ForeignKey("dim_cities", "state_id", "dim_states", "state_id"),
        ForeignKey("dim_users", "role_id", "dim_user_roles", "role_id"),
        ForeignKey("dim_users", "city_id", "dim_cities", "city_id"),
        ForeignKey("dim_products", "category_id", "dim_categories", "category_id"),
        ForeignKey("dim_products", "brand_id", "dim_brands", "brand_id"),
        ForeignKey("fact_orders", "user_id", "dim_users", "user_id"),
        ForeignKey("fact_orders", "product_id", "dim_products", "product_id"),
        ForeignKey("fact_orders", "date_id", "dim_date", "date_id"),
    ],
}

ADDRESS = """struct<address:string,city:string,state:string,stateCode:string,postalCode:string,country:string,
    coordinates:struct<lat:double,lng:double>>"""

RAW = {
    "users": f"""id BIGINT, firstName STRING, lastName STRING, maidenName STRING, age INT, gender STRING, email STRING,
        phone STRING, username STRING, password STRING, birthDate STRING, image STRING, bloodGroup STRING,
        height DOUBLE, weight DOUBLE, eyeColor STRING, hair struct<color:string,type:string>, ip STRING,
        macAddress STRING, userAgent STRING, university STRING, ein STRING, ssn STRING, role STRING,
        crypto struct<coin:string,wallet:string,network:string>,
        bank struct<cardNumber:string,cardType:string,cardExpire:string,currency:string,iban:string>,
        address {ADDRESS},
        company struct<name:string,department:string,title:string,address:{ADDRESS}>""",
    "products": """id BIGINT, title STRING, description STRING, category STRING, price DOUBLE,
        discountPercentage DOUBLE, rating DOUBLE, stock INT, brand STRING, sku STRING, weight DOUBLE,
        dimensions struct<width:double,height:double,depth:double>, warrantyInformation STRING,
        shippingInformation STRING, availabilityStatus STRING, returnPolicy STRING, minimumOrderQuantity INT,
        meta struct<barcode:string,qrCode:string,createdAt:string,updatedAt:string>, thumbnail STRING,
        tags array<string>, images array<string>,
        reviews array<struct<rating:int,comment:string,reviewerName:string,reviewerEmail:string,date:string>>""",
    "carts": """id BIGINT, userId BIGINT, total DOUBLE, discountedTotal DOUBLE, totalProducts INT, totalQuantity INT,
        products array<struct<id:bigint,quantity:int,price:double,discountPercentage:double,
            discountedTotal:double,total:double>>""",
}


@cache
def struct_type(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def schema_of(model: str, table: str) -> T.StructType:
    return struct_type(MODELS[model][table])


def _literal(value) -> str:
    return "'" + value.replace("'", "\\'") + "'" if isinstance(value, str) else str(value).lower()


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Columns of ``schema`` in order and type; absent columns are null, missing values take their default."""
    defaults = defaults or {}
    have = set(df.columns)
    columns = []
    for field in schema.fields:
        dtype = field.dataType.simpleString()
        value = f"CAST({f'`{field.name}`' if field.name in have else 'NULL'} AS {dtype})"
        if field.name in defaults:
            value = f"COALESCE({value}, CAST({_literal(defaults[field.name])} AS {dtype}))"
        columns.append(f"{value} AS `{field.name}`")
    return df.selectExpr(*columns)


def conform_to(df: DataFrame, model: str, table: str) -> DataFrame:
    return conform(df, schema_of(model, table), DEFAULTS.get(model, {}).get(table))
