"""Registration, comparable output columns and the SQL building blocks of the counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchantry.functions.regions import REGION_STATES
from merchantry.sources.retail import LINE_ORDER, NATION_STATES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Types both engines agree on: bigint, double, text; days and moments as ISO texts."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


CTES: dict[str, str] = {}


def _names_in(text: str) -> list[str]:
    import re
    words = set(re.findall(r"[a-z_0-9]+", text))
    return [n for n in CTES if n in words]


def with_ctes(body: str) -> str:
    """``body`` with the building blocks it mentions, and theirs, in order of definition."""
    needed: set[str] = set()
    todo = _names_in(body)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += [n for n in _names_in(CTES[name]) if n not in needed and n != name]
    parts = [f"{n} AS ({CTES[n]})" for n in CTES if n in needed]
    return f"WITH {', '.join(parts)} {body}" if parts else body


CASTS = {
    "d": "CAST({0} AS DOUBLE)", "i": "CAST({0} AS BIGINT)", "day": "strftime({0}, '%Y-%m-%d')",
    "ts": "strftime({0}, '%Y-%m-%d %H:%M:%S')", "s": "CAST({0} AS VARCHAR)", "b": "CAST({0} AS BOOLEAN)",
}


def answer(columns: str, body: str) -> str:
    """SQL text that gives ``columns`` (``name`` or ``name:type``) of the query ``body``."""
    out = []
    for spec in columns.split():
        name, _, kind = spec.partition(":")
        out.append(f"{CASTS[kind].format(name)} AS {name}" if kind else name)
    return with_ctes(f"SELECT {', '.join(out)} FROM ({body}) AS result_rows")


def half_up(num: str, den: str) -> str:
    """Whole-number quotient, half away from zero."""
    n, d = f"CAST({num} AS HUGEINT)", f"NULLIF(CAST({den} AS HUGEINT), 0)"
    return f"(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})))"


def mean(total: str, count: str) -> str:
    return f"({half_up(f'({total}) * 100', count)} / 100.0)"


def percent(part: str, whole: str) -> str:
    return f"({half_up(f'({part}) * 1000000', f'({whole}) * 100')} / 100.0)"


CODES = "[" + ", ".join(f"'{c}'" for c in NATION_STATES) + "]"
REGION_CASE = "CASE " + " ".join(
    f"WHEN state_code IN ({', '.join(repr(c) for c in codes)}) THEN '{region}'" for region, codes in REGION_STATES.items()
) + " ELSE 'Other' END"
PREV = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"

CTES["t_cust"] = f"""
    SELECT c.*, n_nationkey, n_name, n_regionkey, r_name, ({CODES})[n_nationkey + 1] AS code,
        r_name || ' ' || ({CODES})[n_nationkey + 1] AS state,
        CAST(CAST(n_nationkey * 100 + floor(abs(c_acctbal) / 2500) AS BIGINT) AS VARCHAR) AS zone,
        20 + CAST(floor(abs(c_acctbal) / 150) AS INTEGER) AS age,
        CAST(c_acctbal > -800 AS INT) AS has_own, CAST(c_acctbal > 500 AS INT) AS has_work,
        CAST(c_acctbal >= 0 AS INT) AS has_bank, CAST(c_acctbal > -500 AS INT) AS has_company
    FROM customer c LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""
CTES["t_num"] = f"""
    SELECT *, coalesce(sum(has_own + has_work) OVER (ORDER BY c_custkey {PREV}), 0) AS a0,
        coalesce(sum(has_bank) OVER (ORDER BY c_custkey {PREV}), 0) AS b0,
        coalesce(sum(has_company) OVER (ORDER BY c_custkey {PREV}), 0) AS k0
    FROM t_cust"""
CTES["t_addresses"] = """
    SELECT CAST(a0 + 1 AS BIGINT) AS id, c_name || ' Street' AS address_line, n_name AS city, state, code AS state_code,
        zone AS postal_code, 'United States' AS country, n_nationkey * 1.5 AS latitude, n_regionkey * -2.5 AS longitude
    FROM t_num WHERE has_own = 1
    UNION ALL
    SELECT CAST(a0 + has_own + 1 AS BIGINT), 'HQ ' || c_name, n_name, state, code, '9' || zone, 'Canada', n_nationkey * 1.5,
        n_regionkey * -2.5
    FROM t_num WHERE has_work = 1"""
CTES["t_banks"] = """
    SELECT CAST(b0 + 1 AS BIGINT) AS id, CAST(c_custkey AS VARCHAR) AS card_number, c_mktsegment AS card_type,
        '12/30' AS card_expire, r_name AS currency, 'IB' || CAST(c_custkey AS VARCHAR) AS iban
    FROM t_num WHERE has_bank = 1"""
CTES["t_companies"] = """
    SELECT CAST(k0 + 1 AS BIGINT) AS id, c_mktsegment || ' Inc' AS name, r_name AS department, 'Agent' AS title,
        CASE WHEN has_work = 1 THEN CAST(a0 + has_own + 1 AS BIGINT) END AS address_id
    FROM t_num WHERE has_company = 1"""
CTES["t_users"] = """
    SELECT c_custkey AS id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name, age,
        CASE WHEN n_nationkey < 20 THEN 'female' END AS gender,
        lower(replace(c_name, '#', '.') || '@example.com') AS email, '+1-' || CAST(n_nationkey AS VARCHAR) AS phone,
        c_name AS username, DATE '2000-01-01' - age * 365 AS birth_date, 150 + n_nationkey AS height,
        50 + n_nationkey AS weight, lower(c_mktsegment) AS hair_color, n_name AS university,
        CASE WHEN c_mktsegment <> 'BUILDING' THEN lower(c_mktsegment) ELSE 'user' END AS role, r_name AS crypto_coin,
        'w-' || CAST(c_custkey AS VARCHAR) AS crypto_wallet,
        CASE WHEN has_bank = 1 THEN CAST(b0 + 1 AS BIGINT) END AS bank_id,
        CASE WHEN has_company = 1 THEN CAST(k0 + 1 AS BIGINT) END AS company_id,
        CASE WHEN has_own = 1 THEN CAST(a0 + 1 AS BIGINT) END AS address_id, c_acctbal
    FROM t_num"""
CTES["t_cat0"] = """
    SELECT p_partkey, CASE WHEN p_size < 25 THEN p_type WHEN p_size < 50 THEN lower(p_type) ELSE 'uncategorized' END AS cname
    FROM part"""
CTES["t_categories"] = """
    SELECT row_number() OVER (ORDER BY first_product) AS id, name, slug FROM (
        SELECT replace(lower(cname), ' ', '-') AS slug, min(p_partkey) AS first_product, arg_min(cname, p_partkey) AS name
        FROM t_cat0 GROUP BY replace(lower(cname), ' ', '-')) AS firsts"""
CTES["t_products"] = """
    SELECT p_partkey AS id, p_name AS title, p_brand || ' ' || p_name AS description, c.id AS category_id,
        CAST(p_retailprice AS DECIMAL(10,2)) AS price, CAST(p_size / 4.0 AS DECIMAL(5,2)) AS discount_percentage,
        CAST(p_size / 10.0 AS DECIMAL(3,2)) AS rating, p_size AS stock,
        CASE WHEN p_brand <> 'Brand#1' THEN p_brand END AS brand, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
        CAST(p_size AS DECIMAL(10,2)) AS weight,
        CASE WHEN p_size <= 45 THEN CAST(p_size / 2.0 AS DECIMAL(10,2)) END AS width,
        CASE WHEN p_size <= 45 THEN CAST(p_size / 4.0 AS DECIMAL(10,2)) END AS height,
        CASE WHEN p_size <= 45 THEN CAST(p_size / 5.0 AS DECIMAL(10,2)) END AS depth,
        p_type || ' warranty' AS warranty_info,
        CASE WHEN p_size > 10 THEN 'In Stock' ELSE 'Low Stock' END AS availability_status,
        p_size // 10 AS minimum_order_quantity, CAST(p_partkey AS VARCHAR) AS barcode,
        'thumb/' || CAST(p_partkey AS VARCHAR) AS thumbnail_url, TIMESTAMP '2024-01-01 08:30:00' AS created_at,
        TIMESTAMP '2024-06-01 00:00:00' AS updated_at, p_type, p_size, p_brand
    FROM part JOIN t_cat0 USING (p_partkey) JOIN t_categories c ON replace(lower(cname), ' ', '-') = c.slug"""
CTES["t_tags"] = """
    SELECT row_number() OVER (ORDER BY p_partkey, pos) AS id, p_partkey AS product_id, tag, pos FROM (
        SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tag, unnest(range(len(string_split(p_name, ' ')))) AS pos
        FROM part) AS x"""
CTES["t_images"] = """
    SELECT row_number() OVER (ORDER BY p_partkey, i) AS id, p_partkey AS product_id,
        'img/' || CAST(p_partkey AS VARCHAR) || '/' || CAST(i AS VARCHAR) AS image_url, i - 1 AS image_order FROM (
        SELECT p_partkey, unnest(range(1, p_size // 15 + 1)) AS i FROM part) AS x"""
CTES["t_reviews"] = """
    SELECT row_number() OVER (ORDER BY p_partkey, i) AS id, p_partkey AS product_id, (p_size + i) % 5 + 1 AS rating,
        p_brand || ' review ' || CAST(i AS VARCHAR) AS comment, p_type AS reviewer_name,
        lower(p_type) || '@example.com' AS reviewer_email, DATE '2024-01-01' + CAST(i AS INTEGER) AS review_date FROM (
        SELECT *, unnest(range(1, p_size // 10 + 1)) AS i FROM part) AS x"""
CTES["t_lines"] = f"""
    SELECT row_number() OVER (ORDER BY {', '.join(LINE_ORDER)}) AS id, l_orderkey AS order_id, l_partkey AS product_id,
        CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS amount,
        CAST(l_discount AS DECIMAL(4,2)) AS rate
    FROM lineitem"""
CTES["t_items"] = """
    SELECT id, order_id, product_id, quantity,
        CAST(CAST((2 * CAST(amount * 100 AS BIGINT) + quantity) // (2 * quantity) AS DECIMAL(12,0)) * 0.01 AS DECIMAL(12,2)) AS price,
        CAST(rate * 100 AS DECIMAL(5,2)) AS discount_percentage, round(amount - amount * rate, 2) AS discounted_total,
        amount AS total
    FROM t_lines"""
CTES["t_orders"] = """
    SELECT o_orderkey AS id, o_custkey AS user_id, o_orderdate AS order_date, o_orderstatus AS status,
        CAST(o_totalprice AS DECIMAL(12,2)) AS total, round(CAST(o_totalprice AS DECIMAL(12,2)) * 0.95, 2) AS discounted_total,
        coalesce(lines, 0) AS total_products, coalesce(pieces, 0) AS total_quantity
    FROM orders LEFT JOIN (
        SELECT l_orderkey, count(*) AS lines, sum(CAST(l_quantity AS INTEGER)) AS pieces FROM lineitem GROUP BY l_orderkey) AS s
        ON o_orderkey = l_orderkey"""
CTES["t_dates"] = f"""
    SELECT CAST(row_number() OVER (ORDER BY d) AS BIGINT) AS date_id, d AS full_date, year(d) AS year, quarter(d) AS quarter,
        month(d) AS month, monthname(d) AS month_name, day(d) AS day, isodow(d) AS day_of_week, dayname(d) AS day_name,
        weekofyear(d) AS week_of_year, isodow(d) >= 6 AS is_weekend,
        strftime(d, '%m-%d') IN ('01-01', '07-04', '12-25') AS is_holiday,
        year(d) + CASE WHEN month(d) >= 10 THEN 1 ELSE 0 END AS fiscal_year, ((month(d) + 2) % 12) // 3 + 1 AS fiscal_quarter
    FROM (SELECT CAST(unnest(generate_series((SELECT date_trunc('year', min(o_orderdate)) FROM orders), (SELECT date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY FROM orders), INTERVAL 1 DAY)) AS DATE) AS d) AS days"""
CTES["t_locations"] = f"""
    SELECT row_number() OVER (ORDER BY id) AS location_id, *, {REGION_CASE} AS region FROM t_addresses"""
CTES["t_places"] = """
    SELECT u.id AS user_id, l.location_id FROM t_users u JOIN t_addresses a ON u.address_id = a.id JOIN (
        SELECT city, state_code, postal_code, min(location_id) AS location_id FROM t_locations GROUP BY ALL) AS l
        ON a.city = l.city AND a.state_code = l.state_code AND a.postal_code = l.postal_code"""
CTES["t_fact"] = """
    SELECT i.id AS fact_id, i.order_id, o.user_id, i.product_id,
        coalesce(d.date_id, CAST(strftime(o.order_date, '%Y%m%d') AS BIGINT)) AS date_id, p.location_id, quantity,
        price AS unit_price, discount_percentage, subtotal, round(discount, 2) AS discount_amount,
        round(subtotal - discount, 2) AS total_amount, o.status AS order_status
    FROM (SELECT *, price * CAST(quantity AS DECIMAL(10,0)) AS subtotal,
            price * CAST(quantity AS DECIMAL(10,0)) * discount_percentage * 0.01 AS discount FROM t_items) AS i
    JOIN t_orders o ON i.order_id = o.id LEFT JOIN t_dates d ON CAST(o.order_date AS DATE) = d.full_date
    LEFT JOIN t_places p ON o.user_id = p.user_id"""
CTES["t_sprod"] = """
    SELECT p.*, coalesce(c.name, 'Unknown') AS category FROM t_products p LEFT JOIN t_categories c ON p.category_id = c.id"""
CTES["t_roles"] = """
    SELECT * FROM (VALUES (1, 'user', 'Regular user'), (2, 'admin', 'Administrator'), (3, 'moderator', 'Moderator'),
        (4, 'guest', 'Guest user')) AS seeds(role_id, role_name, role_description)
    UNION ALL
    SELECT 4 + row_number() OVER (ORDER BY min(id)), role, 'User role' FROM t_users
    WHERE role NOT IN ('user', 'admin', 'moderator', 'guest') GROUP BY role"""
CTES["t_brands"] = """
    SELECT row_number() OVER (ORDER BY min(id)) AS brand_id, brand AS brand_name, CAST(NULL AS VARCHAR) AS brand_country
    FROM t_products WHERE brand <> '' GROUP BY brand"""
CTES["t_states"] = f"""
    SELECT row_number() OVER (ORDER BY min(id)) AS state_id, arg_max(state, id) AS state_name, state_code,
        {REGION_CASE} AS region, 'United States' AS country
    FROM t_addresses WHERE state_code <> '' AND state <> '' GROUP BY state_code"""
CTES["t_cities"] = """
    SELECT row_number() OVER (ORDER BY min(id)) AS city_id, city AS city_name, state_id, CAST(NULL AS BIGINT) AS population
    FROM t_addresses a JOIN t_states s ON a.state_code = s.state_code WHERE city <> '' GROUP BY city, state_id"""
CTES["t_snowusers"] = """
    SELECT u.*, r.role_id, c.city_id, a.postal_code, a.latitude, a.longitude FROM t_users u
    LEFT JOIN t_addresses a ON u.address_id = a.id LEFT JOIN t_states s ON a.state_code = s.state_code
    LEFT JOIN t_cities c ON c.city_name = a.city AND c.state_id = s.state_id LEFT JOIN t_roles r ON u.role = r.role_name"""
CTES["t_snowprod"] = """
    SELECT p.*, b.brand_id FROM t_products p LEFT JOIN t_brands b ON p.brand = b.brand_name"""
CTES["t_geo"] = """
    SELECT c.city_id, c.city_name, c.population, s.* FROM t_cities c LEFT JOIN t_states s ON c.state_id = s.state_id"""
