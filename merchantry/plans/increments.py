"""Stored models that grow with their source: new files of orders and lines are added, the rest stays as it is."""

from __future__ import annotations

import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchantry import schemas
from merchantry.operators import dimensions
from merchantry.plans.common import ORDER_SUMS, calendar, order_sums
from merchantry.plans.models import declared
from merchantry.schemas import conform_to
from merchantry.sources import retail
from merchantry.sources.store import MONTH, settle
from merchantry.sources.versions import Versions, add, month_of, replace

GROWING = ("orders", "lineitem")
# beside the model: heads of all orders, lines that wait for their order, the location of each user
HEADS, WAITING, PLACES = "order_heads", "waiting_lines", "user_places"
# a month that consists of more parts is written anew as one
MOST_PARTS = 8


def source_files(spark: SparkSession, source: str) -> dict[str, dict[str, list]]:
    """Per table of a folder the length and time of each of its files; no contents are read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source).select("path", "length", F.unix_micros(F.col("modificationTime")))
    out: dict[str, dict[str, list]] = {}
    root = spark._jvm.org.apache.hadoop.fs.Path(source).toUri().getPath().rstrip("/")
    for path, length, time in found.collect():
        name = path[path.index(root) + len(root) + 1 :].split("/")[0].removesuffix(".parquet")
        out.setdefault(name, {})[path] = [length, time]
    return out


def _grown(before: dict, now: dict) -> dict[str, list[str]] | None:
    """The new files of the growing tables; None if anything else has changed."""
    if any(before.get(name) != now.get(name) for name in {*before, *now} - set(GROWING)):
        return None
    if any(now.get(name, {}).get(path) != state for name in GROWING for path, state in before.get(name, {}).items()):
        return None
    return {name: sorted(set(now.get(name, {})) - set(before.get(name, {}))) for name in GROWING}


def _like(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """The columns and types of what is stored."""
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored.schema.fields])


def _with_months(rows: DataFrame, dates: DataFrame) -> DataFrame:
    return rows.join(calendar(dates.withColumn(MONTH, F.col("year") * 100 + F.col("month")), MONTH), "date_id", "left")


def _facts(model: str, heads: DataFrame, items: DataFrame, dates: DataFrame, places: DataFrame | None) -> DataFrame:
    lines = dimensions.fact_lines({"orders": heads, "order_items": items}, dates, places)
    return _with_months(conform_to(lines, model, "fact_orders"), dates)


def _dated_heads(heads: DataFrame, dates: DataFrame) -> DataFrame:
    dated = dimensions.date_ids(heads, dates)
    return _with_months(dated, dates).drop("date_id")


def _build(versions: Versions, source: str, model: str, load_id: str) -> dict:
    """Every table from the whole source; returns what each one was written as."""
    spark = versions.spark
    tables = retail.normalized(spark, source)
    written: dict[str, dict] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        written[name], _ = versions.write(load_id, name, df)
        return versions.read(name, {"tables": written})

    build = {"star": dimensions.build_star, "snowflake": dimensions.build_snowflake}[model]
    built = build(tables, keep=keep)
    for name, df in built.items():
        if name not in written and name != "fact_orders":
            keep(name, df)
    dates, places = versions.read("dim_date", {"tables": written}), None
    if model == "star":
        known = dimensions.address_locations(tables["addresses"], versions.read("dim_location", {"tables": written}))
        users = tables["users"].select(F.col("id").alias("user_id"), "address_id")
        places = keep(PLACES, users.join(known, "address_id").select("user_id", "location_id"))
    heads = tables["orders"].select("id", "user_id", "order_date", "status")
    keep(HEADS, _dated_heads(heads, dates))
    fact = keep("fact_orders", _facts(model, heads, tables["order_items"], dates, places))
    keep(ORDER_SUMS, order_sums({"fact_orders": fact}))
    keep(WAITING, tables["order_items"].join(heads.select(F.col("id").alias("order_id")), "order_id", "left_anti").select(*tables["order_items"].columns))
    top = tables["order_items"].agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    return {"written": written, "top": top}


def _merged(versions: Versions, state: dict, name: str, parts: dict, months: set[str], load_id: str, model: str) -> tuple[dict, list[str]]:
    """One part for each of these months, of old and new ones: what was written, and the parts that it replaces."""
    table = {"tables": {name: {"schema": parts["schema"], "parts": [p for p in state["tables"][name]["parts"] + parts["parts"] if month_of(p) in months]}}}
    rows = versions.read(name, table)
    if name == ORDER_SUMS:
        keys = [c for c in rows.columns if not c.startswith("_")]
        sums = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rows.columns if c.startswith("_")])
        rows = _like(sums, rows)
    written, _ = versions.write(load_id, name, rows)
    return written, table["tables"][name]["parts"]


def _extend(versions: Versions, state: dict, model: str, new: dict[str, list[str]], load_id: str, most_parts: int) -> dict | None:
    """The changes that the new files make; None if a day lies before the calendar, which numbers all days anew."""
    spark, changes = versions.spark, {"add": {}, "replace": {}, "months": {}}
    top = state["notes"]["top"]
    read = lambda name: spark.read.parquet(*new[name]) if new[name] else None
    orders, lines = read("orders"), read("lineitem")
    dates = versions.read("dim_date", state)
    heads = retail.order_keys(orders) if orders is not None else versions.read(HEADS, state, []).drop(MONTH)
    first, last = heads.agg(F.min(F.year("order_date")), F.max(F.year("order_date"))).first()
    known_first, known_last = dates.agg(F.min("year"), F.max("year")).first()
    if first is not None and (known_first is None or first < known_first):
        return None
    if last is not None and last > known_last:
        changes["replace"]["dim_date"], _ = versions.write(load_id, "dim_date", dimensions.date_dimension(spark, known_first, last))
        dates = versions.read("dim_date", {"tables": changes["replace"]})
    if orders is not None:
        changes["add"][HEADS], _ = versions.write(load_id, HEADS, _like(_dated_heads(heads, dates), versions.read(HEADS, state)))
    items = versions.read(WAITING, state)
    if lines is not None:
        numbered = settle(retail.numbered_items(lines, top + 1))
        top = numbered.agg(F.coalesce(F.max("id"), F.lit(top))).first()[0]
        items = items.unionByName(numbered)
    # lines of orders that came before, if there are any, need the heads that are stored
    others = settle(items.join(heads.select(F.col("id").alias("order_id")), "order_id", "left_anti"))
    late = not others.isEmpty()
    if late:
        old = versions.read(HEADS, state).drop(MONTH)
        old = settle(old.join(others.select(F.col("order_id").alias("id")).distinct(), "id", "left_semi").select(*heads.columns))
        heads, others = heads.unionByName(old), others.join(old.select(F.col("id").alias("order_id")), "order_id", "left_anti")
    changes["replace"][WAITING], _ = versions.write(load_id, WAITING, _like(others, versions.read(WAITING, state)))
    places = versions.read(PLACES, state) if model == "star" else None
    facts, _ = versions.write(load_id, "fact_orders", _like(_facts(model, heads, items, dates, places), versions.read("fact_orders", state)))
    fact = versions.read("fact_orders", {"tables": {"fact_orders": facts}})
    sums, _ = versions.write(load_id, ORDER_SUMS, _like(order_sums({"fact_orders": fact}), versions.read(ORDER_SUMS, state)))
    touched = {month_of(p) for p in facts["parts"]}
    for name, parts, whole in (("fact_orders", facts, set()), (ORDER_SUMS, sums, touched if late else set())):
        held = Counter(month_of(p) for p in state["tables"][name]["parts"])
        again = whole | {m for m in touched if held[m] >= most_parts}
        if again:
            changes["months"][name] = _merged(versions, state, name, parts, again, load_id, model)
        changes["add"][name] = {**parts, "parts": [p for p in parts["parts"] if month_of(p) not in again]}
    return {**changes, "top": top}


def update(spark: SparkSession, source: str, folder: str, model: str = "star", most_parts: int = MOST_PARTS) -> dict[str, DataFrame]:
    """Bring the stored model of ``source`` up to date, and give its tables.

    The newest version in ``folder`` knows the files that it was made from. If only files of orders and lines were added, these alone are
    read: line ids go on from the largest one, locations and days are looked up in the stored dictionaries, new facts are added to
    their months, and sums are written anew for months with lines of earlier orders. Lines wait for their order. Any other
    change (another table, a file that went or changed, a day before the calendar) builds the model anew. All tables change in one
    commit. Ids are those of a full build if the new lines come after the old ones in line order.
    """
    versions, now = Versions(spark, folder), source_files(spark, source)
    state, load_id = versions.latest(), uuid.uuid4().hex[:12]
    new = _grown(state["notes"]["files"], now) if state["version"] else None
    if new is None or any(new.values()):
        extended = _extend(versions, state, model, new, load_id, most_parts) if new else None
        done = extended or _build(versions, source, model, load_id)

        def change(latest: dict) -> None:
            if latest["version"] != state["version"] + 1:
                raise RuntimeError("another writer has changed this model; update it again")
            if not extended:
                latest["tables"] = dict(done["written"])
            else:
                for name, parts in done["add"].items():
                    add(latest, name, parts)
                for name, parts in done["replace"].items():
                    replace(latest, name, parts)
                for name, (parts, gone) in done["months"].items():
                    replace(latest, name, parts, gone)
            latest["notes"] = {"files": now, "top": done["top"], "how": "extended" if extended else "built", "model": model}

        versions.commit(load_id, change)
    state = versions.latest()
    return {name: versions.read(name, state) for name in state["tables"]}


def model_tables(model: str, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The declared tables of a model, with their declared columns."""
    return {name: df.select(*schemas.schema_of(model, name).names) for name, df in declared(model, tables).items()}
