"""Sources, sinks and chunked reading. Each entry writes whole given tables and reads them back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from merchantry import schemas
from merchantry.functions.numbering import id_by_key
from merchantry.operators import documents, records
from merchantry.plans import models
from merchantry.registry.base import answer, register
from merchantry.registry.dimensional import FLAT_COUNTS, counts_sql
from merchantry.operators.dimensions import row_counts
from merchantry.sources import avro, clustered, files, retail, sinks, versions
from merchantry.sources.store import at_once, scratch_path
from merchantry.streaming import chunks

GIVEN = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
         "conversations").split()


def table(spark, sf, name):
    return retail.table(spark, sf, name)


def _union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


CUSTOMER = "c_custkey c_name c_nationkey:i c_acctbal:d c_mktsegment"


@register("src_1_csv_typed", answer(CUSTOMER, "SELECT * FROM customer"))
def _(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.write_csv(table(spark, sf, "customer"), path)
    return files.read_csv(spark, path, multi_line=False)  # no line breaks in the names


@register("src_1_csv_cells", """
    SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'BIGINT' WHEN 1 THEN 'DOUBLE' WHEN 2 THEN 'STRING' END AS kind,
        CASE c_custkey % 4 WHEN 0 THEN c_custkey WHEN 1 THEN CAST(c_acctbal AS DOUBLE) END AS number,
        CASE c_custkey % 4 WHEN 2 THEN c_name END AS label FROM customer""")
def _(spark, sf):
    """A column of whole numbers, numbers, texts and empty cells, each cell with a type of its own."""
    key, balance, path = F.col("c_custkey"), F.col("c_acctbal").cast("double"), scratch_path(spark, "cells")
    mixed = F.when(key % 4 == 0, key.cast("string")).when(key % 4 == 1, balance.cast("string")).when(key % 4 == 2, F.col("c_name"))
    sinks.write_csv(table(spark, sf, "customer").select(key, mixed.alias("mixed")), path)
    cells = files.typed_cells(files.read_csv_text(spark, path))
    kind = F.schema_of_variant("mixed")
    return cells.select(
        F.variant_get("c_custkey", "$", "bigint").alias("c_custkey"), kind.alias("kind"),
        F.when(kind != "STRING", F.try_variant_get("mixed", "$", "double")).alias("number"),
        F.when(kind == "STRING", F.variant_get("mixed", "$", "string")).alias("label"))


@register("src_2_csv_text", answer(
    "p_partkey p_name p_brand p_size", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, CAST(p_size AS VARCHAR) AS p_size FROM part"))
def _(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.write_csv(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size"), path)
    return files.read_csv_text(spark, path)


ORDER = "o_orderkey o_custkey o_orderstatus o_totalprice:d o_orderpriority"
DATED_ORDER = ORDER + " o_orderdate:ts"
CHUNK_ROWS = 1000
CHUNKED_SQL = f"SELECT *, (row_number() OVER (ORDER BY o_orderkey) - 1) // {CHUNK_ROWS} AS chunk FROM orders"


def _in_chunks(spark, sf, fmt):
    """All orders written as files of one format and read in chunks of 1000 rows."""
    path, orders = scratch_path(spark, fmt), table(spark, sf, "orders")
    orders.write.format(fmt).options(**(files.CSV_OPTIONS if fmt == "csv" else {})).save(path)
    back = spark.read.schema(orders.schema).options(**(files.CSV_OPTIONS if fmt == "csv" else {})).format(fmt).load(path)
    return chunks.row_chunks(back, ["o_orderkey"], CHUNK_ROWS)


@register("src_3_csv_chunks", answer(DATED_ORDER + " chunk:i", CHUNKED_SQL))
def _(spark, sf):
    return _in_chunks(spark, sf, "csv")


@register("src_4_json_arrays", answer(CUSTOMER, "SELECT * FROM customer"))
def _(spark, sf):
    """Lines that each hold a JSON array of up to 100 records."""
    path, customers = scratch_path(spark, "arrays"), table(spark, sf, "customer")
    _pages(customers, "c_custkey").select(F.to_json("records").alias("value")).write.text(path)
    return files.read_json(spark, path, customers.schema)


def _pages(df, key, size=100):
    """Records in key order, ``size`` to a page."""
    numbered = id_by_key(df, key, "_n", first=0).withColumn("_page", F.call_function("div", "_n", F.lit(size)))
    return numbered.groupBy("_page").agg(F.collect_list(F.struct(*df.columns)).alias("records"))


@register("src_5_json_or_empty", answer(CUSTOMER, "SELECT * FROM customer"))
def _(spark, sf):
    """A table that is there and one that is not."""
    path, customers = scratch_path(spark, "json"), table(spark, sf, "customer")
    sinks.write_json_lines(customers, path)
    there = files.read_table_or_empty(spark, path, customers.schema)
    return there.unionByName(files.read_table_or_empty(spark, scratch_path(spark, "nothing"), customers.schema))


@register("src_6_json_table", answer(CUSTOMER, "SELECT * FROM customer"))
def _(spark, sf):
    path, customers = scratch_path(spark, "json"), table(spark, sf, "customer")
    sinks.write_json_lines(customers, path)
    return files.read_json(spark, path, customers.schema)


@register("src_4_json_documents", answer(CUSTOMER, "SELECT * FROM customer"))
def _(spark, sf):
    """Files that each hold one document spread over many lines: an array of records."""
    path, customers = scratch_path(spark, "documents"), table(spark, sf, "customer")
    pages = _pages(customers, "c_custkey", 500).select(F.to_json("records", {"pretty": "true"}).alias("value"), "_page")
    pages.repartition("_page").write.partitionBy("_page").text(path)
    return files.read_json_documents(spark, f"{path}/*", customers.schema)


@register("src_7_json_chunks", answer(DATED_ORDER + " chunk:i", CHUNKED_SQL))
def _(spark, sf):
    return _in_chunks(spark, sf, "json")


def _lines_with_faults(spark, sf):
    """Events as JSON lines; errors are cut short and searches leave a blank line behind them."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    line = F.to_json(F.struct(*events.columns))
    path = scratch_path(spark, "lines")
    cut = F.when(F.col("event_type") == "error", F.substring_index(line, ",", 2)).otherwise(line)
    events.select(F.explode(F.array(cut, F.when(F.col("event_type") == "click", F.lit("")).otherwise(line))).alias("value")).write.text(path)
    return path, events.schema


EVENTS = "event_id user_id event_type value:d"
KEPT_EVENTS = "SELECT * FROM events WHERE event_type <> 'error' UNION ALL SELECT * FROM events WHERE event_type <> 'click'"


@register("src_8_json_lines", answer(EVENTS, KEPT_EVENTS))
def _(spark, sf):
    path, schema = _lines_with_faults(spark, sf)
    return files.read_json_lines(spark, path, schema)


@register("src_8_json_lines_chunks", answer(EVENTS, KEPT_EVENTS))
def _(spark, sf):
    path, schema = _lines_with_faults(spark, sf)
    return chunks.copy_in_chunks(chunks.chunk_stream(spark, path, "json", schema), scratch_path(spark, "chunks")).drop("chunk")


@register("src_8_skipped_lines", answer("skipped:i", "SELECT count(*) AS skipped FROM events WHERE event_type = 'error'"))
def _(spark, sf):
    path, schema = _lines_with_faults(spark, sf)
    return files.malformed_json_lines(spark, path, schema).agg(F.count("*").alias("skipped"))


PART = "p_partkey p_name p_brand p_type p_size:i p_retailprice:d"

# SQL type -> Avro type
AVRO_CASE = """CASE column_type WHEN 'BIGINT' THEN 'long' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
    WHEN 'TIMESTAMP' THEN 'long local-timestamp-micros' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'long timestamp-micros' WHEN 'DATE' THEN 'int date'
    WHEN 'FLOAT[]' THEN 'array' ELSE column_type END"""


@register("src_18_avro_schemas", answer("table_name place:i column_name avro_type", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, row_number() OVER () AS place, column_name, {AVRO_CASE} AS avro_type FROM (DESCRIBE {n})" for n in GIVEN)))
def _(spark, sf):
    """The Avro schema of every given table, field by field."""
    rows = []
    for name in GIVEN:
        for place, f in enumerate(avro.infer_schema(table(spark, sf, name).schema, name)["fields"], 1):
            kind = f["type"][1] if isinstance(f["type"], list) else f["type"]
            kind = kind if isinstance(kind, str) else " ".join(x for x in (kind["type"], kind.get("logicalType")) if x)
            rows.append((name, place, f["name"], kind))
    return spark.createDataFrame(rows, "table_name string, place long, column_name string, avro_type string")


@register("src_19_avro_schemas_back", answer("table_name same:b", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) > 0 AS same FROM (DESCRIBE {n})" for n in GIVEN)))
def _(spark, sf):
    """Avro schemas turned back are the schemas that they came from."""
    schemas_ = {n: table(spark, sf, n).schema for n in GIVEN}
    rows = [(n, avro.spark_schema(avro.infer_schema(s, n)).simpleString() == s.simpleString()) for n, s in schemas_.items()]
    return spark.createDataFrame(rows, "table_name string, same boolean")


LINE = ("l_orderkey l_partkey l_suppkey l_linenumber:i l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus "
        "l_shipdate:ts")


@register("src_11_parquet_read", answer(LINE, "SELECT * FROM lineitem"))
def _(spark, sf):
    return files.read_parquet(spark, f"{sf}/lineitem.parquet")


@register("src_12_parquet_chunks", answer(DATED_ORDER + " chunk:i", CHUNKED_SQL))
def _(spark, sf):
    return _in_chunks(spark, sf, "parquet")


@register("src_13_parquet_pushdown", answer("l_orderkey l_quantity l_extendedprice", """
    SELECT * FROM lineitem WHERE l_quantity >= 40 AND l_extendedprice < 50000 AND l_returnflag IN ('R', 'A')"""))
def _(spark, sf):
    filters = [("l_quantity", ">=", 40), ("l_extendedprice", "<", 50000), ("l_returnflag", "in", ["R", "A"])]
    return files.read_parquet_where(spark, f"{sf}/lineitem.parquet", filters).select("l_orderkey", "l_quantity", "l_extendedprice")


@register("src_13_clustered_box", answer(LINE, """
    SELECT * FROM lineitem WHERE l_partkey BETWEEN 100 AND 400 AND year(l_shipdate) = 1995"""))
def _(spark, sf):
    """All lines laid out by part and day; a range of both reads the row groups that hold it."""
    path = scratch_path(spark, "clustered-lines")
    lines = table(spark, sf, "lineitem").withColumn("ship_day", F.to_date("l_shipdate"))
    clustered.write_clustered(lines, path, ["l_partkey", "ship_day"])
    box = "l_partkey BETWEEN 100 AND 400 AND ship_day BETWEEN DATE '1995-01-01' AND DATE '1995-12-31'"
    return spark.read.schema(lines.schema).parquet(path).filter(box).drop("ship_day")


@register("prj_9_clustered_lookup", answer(
    "l_orderkey l_partkey l_linenumber:i l_quantity", "SELECT * FROM lineitem WHERE l_orderkey IN (1, 7, 999, 123456789)"))
def _(spark, sf):
    """Lines of some orders from files laid out by part and quantity, by the Bloom filters of the order key."""
    path = scratch_path(spark, "clustered-lines")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    clustered.write_clustered(lines, path, ["l_partkey", "l_quantity"], ["l_orderkey"])
    return records.by_ids(spark.read.schema(lines.schema).parquet(path), [1, 7, 999, 123456789], "l_orderkey")


@register("src_14_parquet_metadata", answer("table_name num_rows:i num_columns:i num_row_groups:i", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, (SELECT count(*) FROM {n}) AS num_rows, (SELECT count(*) FROM (DESCRIBE {n})) AS num_columns, "
    f"CAST(ceil((SELECT count(*) FROM {n}) / 1000.0) AS BIGINT) AS num_row_groups" for n in GIVEN)))
def _(spark, sf):
    """Footers of all tables, written by Spark with row groups of known sizes: one group per file of at most 1000 rows."""
    paths = {n: f"{scratch_path(spark, 'footers')}/{n}.parquet" for n in GIVEN}

    def write(n, path):
        rows = table(spark, sf, n)
        # a task has whole chunks of 1000 rows, but for the last
        chunked = chunks.row_chunks(rows, rows.columns, 1000, "_chunk").repartition("_chunk").drop("_chunk")
        chunked.write.option("maxRecordsPerFile", 1000).parquet(path)

    at_once([lambda n=n, path=path: write(n, path) for n, path in paths.items()])
    facts = _union([files.parquet_metadata(spark, path).withColumn("table_name", F.lit(n)) for n, path in paths.items()])
    return facts.groupBy("table_name").agg(
        F.sum("num_rows").alias("num_rows"), F.max("num_columns").alias("num_columns"), F.sum("num_row_groups").alias("num_row_groups")
    )


@register("src_15_pages", answer(CUSTOMER, "SELECT * FROM customer"))
def _(spark, sf):
    """Landed pages of 100 records each."""
    path, customers = scratch_path(spark, "pages"), table(spark, sf, "customer")
    _pages(customers, "c_custkey").select(F.col("records").alias("users")).write.json(path)
    return files.unnest_pages(spark, path, "users", customers.schema)


@register("src_15_pages_in_order", answer(CUSTOMER, """
    SELECT * FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS place FROM customer) AS c
    WHERE place < (SELECT count(*) FROM customer) // 200 * 100 + 50"""))
def _(spark, sf):
    """Landed pages of 100 records, the middle one cut in half: what lies behind it is not read."""
    path, customers = scratch_path(spark, "pages"), table(spark, sf, "customer")
    middle = customers.agg(F.call_function("div", F.count("*"), F.lit(200))).scalar()
    numbered = id_by_key(customers, "c_custkey", "_n", first=0).withColumn("_page", F.call_function("div", "_n", F.lit(100)))
    landed = numbered.filter((F.col("_page") != middle) | (F.col("_n") % 100 < 50))
    pages = landed.groupBy("_page").agg(F.collect_list(F.struct(*customers.columns)).alias("users"))
    pages.select("users", (F.col("_page") * 100).alias("skip")).write.json(path)
    return files.unnest_pages_in_order(spark, path, "users", customers.schema, 100)


@register("src_16_full_scan", answer("s_suppkey s_name s_nationkey:i s_acctbal:d", "SELECT * FROM supplier"))
def _(spark, sf):
    table(spark, sf, "supplier").createOrReplaceTempView("merchantry_supplier")
    return spark.table("merchantry_supplier")


@register("src_17_file_facts", answer("row_count:i column_count:i has_size:b", """
    SELECT (SELECT count(*) FROM lineitem) AS row_count, 11 AS column_count, TRUE AS has_size"""))
def _(spark, sf):
    path = f"{sf}/lineitem.parquet"
    return files.shape(files.read_parquet(spark, path)).withColumn("has_size", files.size_mb(spark, path).scalar() > 0)


@register("snk_1_csv", answer(ORDER + " o_orderdate:ts", "SELECT * FROM orders"))
def _(spark, sf):
    path, orders = scratch_path(spark, "csv"), table(spark, sf, "orders")
    sinks.write_csv(orders, path)
    return files.read_csv(spark, path, orders.schema, multi_line=False)


CONVERSATIONS = "conv_id turn role text"


@register("snk_2_json", answer(CONVERSATIONS, "SELECT * FROM conversations"))
def _(spark, sf):
    path, talks = scratch_path(spark, "json"), table(spark, sf, "conversations")
    sinks.write_json_lines(talks, path)
    return spark.read.schema(talks.schema).json(path)


@register("snk_3_json_lines", answer("doc_id text lang source n_chars", "SELECT * FROM documents"))
def _(spark, sf):
    path, docs = scratch_path(spark, "lines"), table(spark, sf, "documents")
    sinks.write_json_lines(docs, path)
    return files.read_json_lines(spark, path, docs.schema)


@register("snk_5_parquet_codecs", answer("codec p_partkey p_name p_retailprice:d", f"""
    SELECT unnest({sinks.PARQUET_CODECS}) AS codec, p_partkey, p_name, p_retailprice FROM part"""))
def _(spark, sf):
    parts, frames = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice"), []
    for codec in sinks.PARQUET_CODECS:
        path = scratch_path(spark, codec)
        sinks.write_parquet(parts, path, codec)
        frames.append(files.read_parquet(spark, path).withColumn("codec", F.lit(codec)))
    return _union(frames)


@register("snk_6_save_tables", counts_sql(FLAT_COUNTS))
def _(spark, sf):
    paths = sinks.save_tables(models.normalized(spark, sf), scratch_path(spark, "saved"))
    return row_counts({name: files.read_parquet(spark, path) for name, path in paths.items()})


@register("snk_7_land_raw", answer('kind id label', """
    SELECT 'product json' AS kind, id, title AS label FROM t_products UNION ALL SELECT 'product csv', id, sku FROM t_products
    UNION ALL SELECT 'user json', id, username FROM t_users UNION ALL SELECT 'user csv', u.id, a.city FROM t_users u
    LEFT JOIN t_addresses a ON u.address_id = a.id"""))
def _(spark, sf):
    paths = records.land_raw(
        {"users": retail.raw_users(spark, sf), "products": retail.raw_products(spark, sf)}, scratch_path(spark, "raw")
    )
    picks = [("product json", "products.json", "title"), ("product csv", "products.csv", "sku"),
             ("user json", "users.json", "username"), ("user csv", "users.csv", "address_city")]
    frames = []
    for kind, name, label in picks:
        if name.endswith("csv"):
            df = files.read_csv(spark, paths[name])
        else:
            df = spark.read.schema(schemas.struct_type(schemas.RAW[name.split(".")[0]])).json(paths[name])
        frames.append(df.select(F.lit(kind).alias("kind"), "id", F.col(label).alias("label")))
    return _union(frames)


@register("snk_8_append", answer("id user_id total:d", "SELECT * FROM t_orders"))
def _(spark, sf):
    """Orders appended status by status."""
    folder, orders = scratch_path(spark, "appended"), models.normalized(spark, sf)["orders"]
    for status in ("F", "O", "P"):
        sinks.append_tables({"orders": orders.filter(F.col("status") == status)}, folder)
    return files.read_parquet(spark, f"{folder}/orders").select("id", "user_id", "total")


def _loaded(spark, sf):
    """Users in one load and orders in one per status; one load is run twice, and one breaks before it commits."""
    folder, tables = scratch_path(spark, "loads"), models.normalized(spark, sf)
    users, orders = tables["users"], tables["orders"]
    versions.load({"orders": orders.filter("status = 'F'"), "users": users}, folder, "users and F")
    for load_id in ("O", "P", "O"):
        versions.load({"orders": orders.filter(F.col("status") == load_id)}, folder, load_id)
    versions.Versions(spark, folder).write("broken", "orders", orders)
    return folder


@register("snk_8_committed_loads", answer("id user_id total:d username", """
    SELECT o.id, o.user_id, o.total, u.username FROM t_orders o LEFT JOIN t_users u ON o.user_id = u.id"""))
def _(spark, sf):
    """Each row once, though a load was repeated and another one broke."""
    folder = _loaded(spark, sf)
    users = versions.read(spark, folder, "users").select(F.col("id").alias("user_id"), "username")
    return versions.read(spark, folder, "orders").select("id", "user_id", "total").join(users, "user_id", "left")


@register("snk_8_load_log", answer("load_id place:i table_name row_count:i", """
    SELECT 'users and F' AS load_id, 0 AS place, 'users' AS table_name, count(*) AS row_count FROM t_users
    UNION ALL SELECT CASE status WHEN 'F' THEN 'users and F' ELSE status END, CASE status WHEN 'F' THEN 1 ELSE 0 END, 'orders', count(*)
    FROM t_orders GROUP BY status"""))
def _(spark, sf):
    """Parents before children, each committed load once."""
    return versions.loads(spark, _loaded(spark, sf))


def _brand_rows(spark, sf, condition):
    return table(spark, sf, "part").filter(condition).select(F.col("p_brand").alias("brand"), "p_partkey", "p_type")


@register("snk_9_insert_ignore", answer("brand p_partkey p_type", """
    SELECT brand, p_partkey, p_type FROM (
        SELECT p_brand AS brand, p_partkey, p_type, row_number() OVER (
            PARTITION BY p_brand ORDER BY CASE WHEN p_retailprice < 905 THEN 0 ELSE 1 END, p_partkey) AS rn FROM part) AS r WHERE rn = 1"""))
def _(spark, sf):
    """The first part of each brand; the cheap parts were there before."""
    first = sinks.insert_ignore(_brand_rows(spark, sf, "FALSE"), _brand_rows(spark, sf, "p_retailprice < 905"), ["brand"], "p_partkey")
    return sinks.upsert_ignore(first, _brand_rows(spark, sf, "p_retailprice >= 905"), ["brand"], "p_partkey")


@register("snk_10_generated_ids", answer("id:i p_type p_partkey", """
    SELECT (SELECT max(p_partkey) FROM part WHERE p_type = 'ECONOMY') + row_number() OVER (ORDER BY p_partkey) AS id, p_type, p_partkey
    FROM part WHERE p_type <> 'ECONOMY'"""))
def _(spark, sf):
    parts = table(spark, sf, "part")
    existing = parts.filter("p_type = 'ECONOMY'").select(F.col("p_partkey").alias("id"))
    new = parts.filter("p_type <> 'ECONOMY'").select("p_type", "p_partkey")
    return sinks.with_generated_ids(new, existing, "id", "p_partkey")


@register("snk_11_collections", answer("_id username city", """
    SELECT o.id AS _id, u.username, a.city FROM t_orders o LEFT JOIN t_users u ON o.user_id = u.id
    LEFT JOIN t_addresses a ON u.address_id = a.id"""))
def _(spark, sf):
    """Order and user documents written as JSON and joined again by user."""
    built = documents.denormalize(models.normalized(spark, sf))
    paths = sinks.write_collections({n: built[n] for n in ("users", "orders")}, scratch_path(spark, "collections"))
    users = spark.read.schema(built["users"].schema).json(paths["users"])
    orders = spark.read.schema(built["orders"].schema).json(paths["orders"])
    cities = users.select(F.col("_id").alias("user_id"), F.col("address.city").alias("city"))
    return orders.select("_id", F.col("user.id").alias("user_id"), F.col("user.username").alias("username")).join(
        cities, "user_id", "left"
    ).drop("user_id")


@register("snk_12_replace", answer(PART, "SELECT * FROM part WHERE p_size > 25"))
def _(spark, sf):
    path, parts = scratch_path(spark, "replaced"), table(spark, sf, "part")
    for rows in (parts, parts.filter("p_size > 25")):
        sinks.save_tables({"part": rows}, path)
    return files.read_parquet(spark, f"{path}/part")


@register("snk_13_declared_schema", answer(
    "id user_id order_date:ts status total:d discounted_total:d total_products:i total_quantity:i", """
    SELECT o_orderkey AS id, o_custkey AS user_id, o_orderdate AS order_date,
        CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE o_orderstatus END AS status, o_totalprice AS total,
        NULL AS discounted_total, NULL AS total_products, NULL AS total_quantity FROM orders"""))
def _(spark, sf):
    """Absent columns are null and a missing status takes its default."""
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id", "o_custkey AS user_id", "o_orderdate AS order_date", "nullif(o_orderstatus, 'P') AS status",
        "o_totalprice AS total",
    )
    return schemas.conform_to(rows, "normalized", "orders")


EXPORT = "fact_id order_id date_id:i unit_price total_amount order_status"


@register("snk_14_fact_export", answer("kind " + EXPORT, """
    SELECT unnest(['json', 'parquet']) AS kind, fact_id, order_id, date_id, CAST(unit_price AS DOUBLE) AS unit_price,
        CAST(total_amount AS DOUBLE) AS total_amount, order_status FROM t_fact"""))
def _(spark, sf):
    fact = models.star(spark, sf)["fact_orders"]
    paths = sinks.export_fact(fact, scratch_path(spark, "export"))
    schema = sinks.export_ready(fact).schema
    frames = [spark.read.schema(schema).format(kind).load(path).withColumn("kind", F.lit(kind)) for kind, path in paths.items()]
    return _union(frames).select("kind", "fact_id", "order_id", "date_id", "unit_price", "total_amount", "order_status")


@register("snk_14_iso_export", answer("id order_date", "SELECT id, strftime(order_date, '%Y-%m-%dT%H:%M:%S') AS order_date FROM t_orders"))
def _(spark, sf):
    return sinks.export_ready(models.normalized(spark, sf)["orders"].select("id", "order_date"))


@register("str_1_chunk_sizes", answer("chunk:i row_count:i first_key total:d", f"""
    SELECT chunk, count(*) AS row_count, min(o_orderkey) AS first_key, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total
    FROM ({CHUNKED_SQL}) AS c GROUP BY chunk"""))
def _(spark, sf):
    """Chunks of 1000 rows; no row is lost."""
    return _in_chunks(spark, sf, "json").groupBy("chunk").agg(
        F.count("*").alias("row_count"), F.min("o_orderkey").alias("first_key"), F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("total"))


@register("str_1_chunk_work", answer("chunk:i row_count:i first_key:i last_key:i dearest_at:i", f"""
    SELECT chunk, count(*) AS row_count, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key,
        max(CASE WHEN dear = 1 THEN place END) AS dearest_at
    FROM (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY o_orderkey) - 1 AS place,
        row_number() OVER (PARTITION BY chunk ORDER BY o_totalprice DESC, o_orderkey) AS dear FROM ({CHUNKED_SQL}) AS c) AS d
    GROUP BY chunk"""))
def _(spark, sf):
    """A function that gets each chunk of 1000 orders in order: its ends and the place of its dearest order."""
    def ends(rows, number):
        keys, prices = rows["o_orderkey"], rows["o_totalprice"].astype(float)
        return rows.head(1).assign(
            chunk=number, row_count=len(rows), first_key=keys.iloc[0], last_key=keys.iloc[-1], dearest_at=int(prices.argmax())
        )[["chunk", "row_count", "first_key", "last_key", "dearest_at"]]

    schema = "chunk long, row_count long, first_key long, last_key long, dearest_at long"
    return chunks.map_rows(table(spark, sf, "orders"), ["o_orderkey"], ends, schema, CHUNK_ROWS)


@register("str_1_file_stream", answer(DATED_ORDER, "SELECT * FROM orders"))
def _(spark, sf):
    """A stream over files, one file per micro-batch, until all are read."""
    path, orders = scratch_path(spark, "stream"), table(spark, sf, "orders")
    orders.write.option("maxRecordsPerFile", chunks.rows_per_file(orders.count(), 5000)).json(path)
    return chunks.copy_in_chunks(chunks.chunk_stream(spark, path, "json", orders.schema), scratch_path(spark, "chunks")).drop("chunk")
