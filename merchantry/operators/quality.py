"""Data quality rules. Every finding is a row ``(table_name, rule, severity, record_key, message)``.

All row rules of a table are evaluated in one scan; key rules are anti joins and group counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchantry import schemas
from merchantry.functions.text import is_set
from merchantry.sources.store import at_once, settle

# Fixed values in this module: rule names and the texts of messages.
FINDING = "table_name STRING, rule STRING, severity STRING, record_key STRING, message STRING"
ERROR, WARNING = "error", "warning"
SAMPLES = {ERROR: 5, WARNING: 3}

COUNTED_TABLES = ["users", "products", "orders", "order_items", "addresses", "categories", "banks", "companies"]
COUNTED_FOREIGN_KEYS = [("orders", "user_id"), ("products", "category_id")]
CHECKED_FOREIGN_KEYS = [
    ("orders", "user_id"), ("order_items", "order_id"), ("order_items", "product_id"), ("users", "address_id"),
    ("products", "category_id"),
]


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    broken: Column
    message: Column


def _says(text: str, c: Column | None = None) -> Column:
    return F.lit(text) if c is None else F.concat(F.lit(f"{text}: "), c.cast("string"))


def _missing(table: str, field: str, text: str) -> Rule:
    return Rule(f"{table}_{field}_missing", ERROR, F.col(field).isNull(), _says(text))


def _broken(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def user_rules() -> list[Rule]:
    email, age = F.col("email"), F.col("age")
    return [
        *[_missing("users", f, f"Missing required field '{f}'") for f in ("id", "email", "username")],
        Rule("users_email_format", WARNING, _broken((email != "") & ~email.contains("@")),
             _says("Invalid email format", email)),
        Rule("users_age_range", WARNING, _broken((age != 0) & ~((age > 0) & (age < 120))),
             _says("Suspicious age value", age)),
    ]


def product_rules() -> list[Rule]:
    price, stock, rating = F.col("price"), F.col("stock"), F.col("rating")
    return [
        _missing("products", "id", "Missing 'id'"),
        Rule("products_title_missing", ERROR, F.coalesce(F.col("title"), F.lit("")) == "", _says("Missing 'title'")),
        Rule("products_price_negative", ERROR, _broken(price < 0), _says("Negative price", price)),
        Rule("products_stock_negative", WARNING, _broken(stock < 0), _says("Negative stock", stock)),
        Rule("products_rating_range", WARNING, _broken(~rating.between(0, 5)), _says("Rating out of range", rating)),
    ]


def order_rules() -> list[Rule]:
    total = F.col("total")
    return [
        _missing("orders", "id", "Missing 'id'"), _missing("orders", "user_id", "Missing 'user_id'"),
        Rule("orders_total_negative", ERROR, _broken(total < 0), _says("Negative total", total)),
    ]


def order_item_rules() -> list[Rule]:
    quantity = F.col("quantity")
    return [
        *[_missing("order_items", f, f"Missing '{f}'") for f in ("order_id", "product_id", "quantity")],
        Rule("order_items_quantity_negative", ERROR, _broken(quantity < 0), _says("Invalid quantity", quantity)),
    ]


def address_rules() -> list[Rule]:
    empty = lambda f: F.coalesce(F.col(f), F.lit("")) == ""
    return [
        _missing("addresses", "id", "Missing 'id'"),
        Rule("addresses_place_missing", WARNING, empty("city") & empty("state"), _says("Missing both city and state")),
    ]


def row_rules() -> dict[str, list[Rule]]:
    return {
        "users": user_rules(), "products": product_rules(), "orders": order_rules(),
        "order_items": order_item_rules(), "addresses": address_rules(),
    }


def check_rows(df: DataFrame, table: str, rules: list[Rule], key: str = "id") -> DataFrame:
    """Findings of all ``rules`` in a single pass over ``df``."""
    found = F.array(*[
        F.when(r.broken, F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), r.message.alias("message")))
        for r in rules
    ])
    return (
        df.select(F.col(key).cast("string").alias("record_key"), F.explode(F.filter(found, lambda f: f.isNotNull())).alias("f"))
        .select(F.lit(table).alias("table_name"), "f.rule", "f.severity", "record_key", "f.message")
    )


def not_null_rules(model: str, table: str) -> list[Rule]:
    """Declared NOT NULL columns."""
    return [
        Rule(f"{table}_{f.name}_not_null", ERROR, F.col(f.name).isNull(), _says(f"Null in column '{f.name}'"))
        for f in schemas.schema_of(model, table).fields if not f.nullable
    ]


def review_rating_rule() -> Rule:
    rating = F.col("rating")
    return Rule("reviews_rating_check", ERROR, _broken(~rating.between(1, 5)), _says("Rating out of range", rating))


def _place(column: str) -> tuple[Column, Column]:
    """The block of 64 whole numbers that a key lies in, and its bit there."""
    key = F.col(column).cast("bigint")
    return F.shiftright(key, 6), F.call_function("shiftleft", F.lit(1).cast("bigint"), key.bitwiseAND(F.lit(63)).cast("int"))


def key_blocks(df: DataFrame, column: str) -> DataFrame:
    """``(_block, _known)``: the whole numbers in ``column``, 64 to a row, with a bit for each that occurs.

    They are stored, so that Spark knows their size before it joins: keys without wide gaps fit a broadcast where a column of
    them does not, and rows that refer to them are not shuffled. Others take a row each and are shuffled like any join.
    """
    block, bit = _place(column)
    return settle(df.filter(F.col(column).isNotNull()).groupBy(block.alias("_block")).agg(F.bit_or(bit).alias("_known")))


def known_rows(df: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """The rows whose key is in the ``key_blocks``, which null is not. As in ``orphans``, only the blocks may be broadcast."""
    block, bit = _place(column)
    found = F.coalesce("_known", F.lit(0)).bitwiseAND(bit) != 0
    return df.join(known, block == F.col("_block"), "left").filter(found).select(*df.columns)


def crowded_blocks(df: DataFrame, column: str) -> DataFrame:
    """``(_block)``: the blocks of 64 whole numbers with more rows than numbers, which is where a key is repeated; stored."""
    block, bit = _place(column)
    counts = df.filter(F.col(column).isNotNull()).groupBy(block.alias("_block")).agg(F.count("*").alias("_n"), F.bit_or(bit).alias("_known"))
    return settle(counts.filter(F.col("_n") > F.bit_count("_known")).select("_block"))


def orphans(
    child: DataFrame, parent: DataFrame, column: str, parent_column: str = "id", known: DataFrame | None = None
) -> DataFrame:
    """Child rows whose key is set (not null, not 0) and has no parent; ``known`` may give the ``key_blocks`` of the parents."""
    set_keys = child.filter(is_set(column, child.schema[column].dataType))
    if known is not None:
        block, bit = _place(column)
        found = F.coalesce("_known", F.lit(0)).bitwiseAND(bit) != 0
        return set_keys.join(known, block == F.col("_block"), "left").filter(~found).select(*child.columns)
    parents = parent.select(F.col(parent_column).alias("_parent_key"))
    return set_keys.join(parents, F.col(column) == F.col("_parent_key"), "left_anti")


def check_foreign_key(
    tables: dict[str, DataFrame], fk: schemas.ForeignKey, key: str = "id", known: DataFrame | None = None
) -> DataFrame:
    message = F.concat(
        F.lit(f"{fk.column} "), F.col(fk.column).cast("string"), F.lit(f" not found in {fk.parent}")
    )
    return orphans(tables[fk.child], tables[fk.parent], fk.column, fk.parent_column, known).select(
        F.lit(fk.child).alias("table_name"), F.lit(f"{fk.child}_{fk.column}_fk").alias("rule"),
        F.lit(ERROR).alias("severity"), F.col(key).cast("string").alias("record_key"), message.alias("message"),
    )


def check_unique(df: DataFrame, table: str, columns: list[str], crowded: DataFrame | None = None) -> DataFrame:
    """One finding per repeated key; counts are combined before the shuffle. ``crowded`` may give the ``crowded_blocks`` of
    a single key, so that only rows in these are counted by key.
    """
    if crowded is not None:
        df = df.join(crowded, _place(columns[0])[0] == F.col("_block"), "left_semi")
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    repeated = df.filter(whole).groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")
    return repeated.select(
        F.lit(table).alias("table_name"), F.lit(f"{table}_{'_'.join(columns)}_unique").alias("rule"),
        F.lit(ERROR).alias("severity"), key.alias("record_key"),
        F.concat(F.lit("Key occurs "), F.col("n").cast("string"), F.lit(" times")).alias("message"),
    )


def check_not_empty(df: DataFrame, table: str) -> DataFrame:
    """A warning if the table has no rows; reads at most one."""
    return df.limit(1).agg(F.count("*").alias("n")).filter("n = 0").select(
        F.lit(table).alias("table_name"), F.lit(f"{table}_empty").alias("rule"), F.lit(WARNING).alias("severity"),
        F.lit(None).cast("string").alias("record_key"), F.lit("File is empty").alias("message"),
    )


def open_tables(
    spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", expected: dict[str, T.StructType] | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables that can be read, and an error row for each that cannot."""
    tables, failures = {}, []
    for name, path in paths.items():
        reader = spark.read.format(fmt)
        if expected and name in expected:
            reader = reader.schema(expected[name])
        try:
            tables[name] = reader.load(path)
        except AnalysisException as error:
            text = "File not found" if error.getCondition() == "PATH_NOT_FOUND" else f"Error reading file: {error.getCondition()}"
            failures.append((name, f"{name}_readable", ERROR, None, f"{text}: {path}"))
    return tables, spark.createDataFrame(failures, FINDING)


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def validate(tables: dict[str, DataFrame]) -> DataFrame:
    """Row rules, empty tables and the five foreign keys of the flat tables."""
    found = [check_not_empty(df, name) for name, df in tables.items()]
    found += [check_rows(tables[name], name, rules) for name, rules in row_rules().items() if name in tables]
    for fk in schemas.FOREIGN_KEYS["normalized"]:
        if (fk.child, fk.column) in CHECKED_FOREIGN_KEYS and fk.child in tables and fk.parent in tables:
            found.append(check_foreign_key(tables, fk))
    return union_all(found)


def validate_declared(model: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Declared NOT NULL, unique, check and foreign key constraints of a model.

    The keys that others refer to are stored once as ``key_blocks``, the blocks of repeated keys as ``crowded_blocks``, so that
    this runs jobs.
    """
    found, tables = [], dict(tables.items())
    foreign = [fk for fk in schemas.FOREIGN_KEYS[model] if fk.child in tables and fk.parent in tables]
    known: dict[tuple[str, str], DataFrame] = {}
    crowded: dict[tuple[str, str], DataFrame] = {}
    parents = {(fk.parent, fk.parent_column) for fk in foreign if _whole(tables[fk.child], fk.column)}
    unique = {(name, columns[0]) for name in tables for columns in schemas.UNIQUE_KEYS[model][name] if len(columns) == 1}
    at_once([
        lambda k=kept, b=blocks, n=name, c=column: k.update({(n, c): b(tables[n], c)})
        for kept, blocks, places in ((known, key_blocks, parents), (crowded, crowded_blocks, unique))
        for name, column in sorted(places) if _whole(tables[name], column)
    ])
    for name, df in tables.items():
        keys = schemas.UNIQUE_KEYS[model][name]
        rules = not_null_rules(model, name)
        if (model, name) == ("normalized", "reviews"):
            rules.append(review_rating_rule())
        found.append(check_rows(df, name, rules, keys[0][0]))
        found += [check_unique(df, name, columns, crowded.get((name, columns[0])) if len(columns) == 1 else None) for columns in keys]
    for fk in foreign:
        blocks = known.get((fk.parent, fk.parent_column)) if _whole(tables[fk.child], fk.column) else None
        found.append(check_foreign_key(tables, fk, schemas.UNIQUE_KEYS[model][fk.child][0][0], blocks))
    return union_all(found)


def _whole(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def orphan_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of orphans of two foreign keys."""
    counts = []
    for fk in schemas.FOREIGN_KEYS["normalized"]:
        if (fk.child, fk.column) in COUNTED_FOREIGN_KEYS:
            parents = tables[fk.parent].select(F.col(fk.parent_column).alias("_parent_key"))
            lost = tables[fk.child].filter(F.col(fk.column).isNotNull()).join(
                parents, F.col(fk.column) == F.col("_parent_key"), "left_anti"
            )
            counts.append(lost.agg(F.count("*").alias("orphans")).select(
                F.lit(f"{fk.child}.{fk.column}").alias("foreign_key"), "orphans"
            ))
    return union_all(counts)


def counted_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of the eight main tables and their total."""
    counts = union_all([
        tables[n].agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n in COUNTED_TABLES if n in tables
    ])
    total = counts.agg(F.sum("row_count").alias("row_count")).select(F.lit("total").alias("table_name"), "row_count")
    return counts.unionByName(total)


def summary(findings: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """One row: tables checked, records, errors, warnings, passed (warnings are allowed)."""
    records = union_all([df.agg(F.count("*").alias("n")) for df in tables.values()]).agg(F.sum("n").alias("n"))
    return findings.agg(
        F.count_if(F.col("severity") == ERROR).alias("errors"), F.count_if(F.col("severity") == WARNING).alias("warnings")
    ).select(
        F.lit(len(tables)).cast("bigint").alias("tables_checked"), records.scalar().alias("total_records"),
        "errors", "warnings", (F.col("errors") == 0).alias("passed"),
    )


def counts_by_table(findings: DataFrame) -> DataFrame:
    return findings.groupBy("table_name", "severity").agg(F.count("*").alias("findings"))


def samples(findings: DataFrame) -> DataFrame:
    """The first findings per table and severity: five errors, three warnings.

    Two rank filters instead of one mixed one, so that each limit is applied before the shuffle.
    """
    w = Window.partitionBy("table_name").orderBy("record_key", "rule", "message")
    return union_all([
        findings.filter(F.col("severity") == severity).withColumn("n", F.row_number().over(w)).filter(F.col("n") <= count).drop("n")
        for severity, count in SAMPLES.items()
    ])
