"""The keyed snapshot."""

from __future__ import annotations

from pyspark.sql import functions as F

from merchantry.operators import cache
from merchantry.plans import models
from merchantry.registry.base import answer, register
from merchantry.sources import retail
from merchantry.sources.buckets import Buckets
from merchantry.sources.store import scratch_path

NOON, LATER, NEXT_DAY = "2025-01-01 12:00:00", "2025-01-01 12:45:00", "2025-01-02 11:59:59"


def _entities(spark, sf):
    tables = models.normalized(spark, sf)
    return {
        "user": tables["users"].select("id", "username", "email", "role"),
        "product": tables["products"].select("id", "title", "brand", "stock"),
        "order": tables["orders"].select("id", "user_id", "status", "total_quantity"),
    }


def snapshot(spark, sf):
    return cache.load(_entities(spark, sf), NOON)


ENTRIES = """
    SELECT 'user:' || id AS key, 'user' AS entity, id, username AS label, TIMESTAMP '2025-01-01 13:00:00' AS expires_at FROM t_users WHERE id <> 0
    UNION ALL SELECT 'product:' || id, 'product', id, title, TIMESTAMP '2025-01-02 12:00:00' FROM t_products WHERE id <> 0
    UNION ALL SELECT 'order:' || id, 'order', id, status, TIMESTAMP '2025-01-01 12:30:00' FROM t_orders WHERE id <> 0"""


def label():
    return F.coalesce(*[F.get_json_object("value", f"$.{f}") for f in ("username", "title", "status")]).alias("label")


@register("kv_1_put", answer("key entity id label expires_at:ts", ENTRIES))
def _(spark, sf):
    return snapshot(spark, sf).select("key", "entity", "id", label(), "expires_at")


@register("kv_1_put_values", answer("key value:s", """
    SELECT 'user:' || id AS key, json_object('id', id, 'username', username, 'email', email, 'role', role) AS value FROM t_users WHERE id <> 0
    UNION ALL SELECT 'product:' || id, json_object('id', id, 'title', title, 'brand', brand, 'stock', stock) FROM t_products WHERE id <> 0
    UNION ALL SELECT 'order:' || id, json_object('id', id, 'user_id', user_id, 'status', status, 'total_quantity', total_quantity)
    FROM t_orders WHERE id <> 0"""))
def _(spark, sf):
    """The JSON value of every entry."""
    return snapshot(spark, sf).select("key", "value")


WHOLE = "id username first_name last_name age:i gender phone birth_date:day university role address_id company_id bank_id"


@register("kv_1_put_whole_records", answer(WHOLE, "SELECT * FROM t_users WHERE id <> 0"))
def _(spark, sf):
    """Whole users through the cache and back."""
    users = models.normalized(spark, sf)["users"]
    return cache.parsed(cache.entries(users, "user", NOON), users.schema).select(*[c.split(":")[0] for c in WHOLE.split()])


@register("kv_2_put_batch", answer("key label", """
    SELECT 'user:' || id AS key, CASE WHEN age > 70 THEN 'renamed ' || username ELSE username END AS label FROM t_users WHERE id <> 0"""))
def _(spark, sf):
    """A batch of changed users put over the snapshot of all."""
    users = _entities(spark, sf)["user"].join(models.normalized(spark, sf)["users"].select("id", "age"), "id")
    changed = users.filter("age > 70").withColumn("username", F.concat(F.lit("renamed "), "username")).drop("age")
    whole = cache.entries(users.drop("age"), "user", NOON)
    return cache.put(whole, cache.entries(changed, "user", LATER)).select("key", label())


@register("kv_1_put_report", answer("entity total:i cached:i", """
    SELECT 'user' AS entity, count(*) AS total, count(*) FILTER (id <> 0) AS cached FROM t_users"""))
def _(spark, sf):
    return cache.put_report(_entities(spark, sf)["user"], "user")


@register("kv_1_last_write_wins", answer("key value:s", """
    SELECT 'visit:' || user_id AS key, json_object('id', user_id, 'event_type', arg_max(event_type, event_id)) AS value
    FROM events WHERE user_id <> 0 GROUP BY user_id"""))
def _(spark, sf):
    """Every event overwrites the entry of its user."""
    visits = retail.table(spark, sf, "events").select(F.col("user_id").alias("id"), "event_type", "event_id")
    return cache.entries(visits, "visit", NOON, position="event_id").select("key", "value")


@register("kv_3_get", answer("id title brand stock:i", "SELECT id, title, brand, stock FROM t_products WHERE id = 12"))
def _(spark, sf):
    found = cache.get(snapshot(spark, sf), "product:12", LATER)
    return cache.parsed(found, _entities(spark, sf)["product"].schema)


@register("kv_3_get_many", answer("key label", f"""
    SELECT key, label FROM ({ENTRIES}) AS e WHERE entity = 'user' AND id IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')"""))
def _(spark, sf):
    """Users and orders are asked for; the orders have expired."""
    open_orders = retail.table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    keys = open_orders.select(F.concat(F.lit("user:"), F.col("o_custkey").cast("string")).alias("key")).unionByName(
        open_orders.select(F.concat(F.lit("order:"), F.col("o_orderkey").cast("string")).alias("key"))
    )
    return cache.get_many(snapshot(spark, sf), keys, LATER).select("key", label())


def _banned(spark, sf):
    users = models.normalized(spark, sf)["users"].filter("age > 80")
    return users.select(F.concat(F.lit("user:"), F.col("id").cast("string")).alias("key"))


@register("kv_4_delete", answer("key", f"""
    SELECT key FROM ({ENTRIES}) AS e WHERE NOT (entity = 'user' AND id IN (SELECT id FROM t_users WHERE age > 80))"""))
def _(spark, sf):
    return cache.delete(snapshot(spark, sf), _banned(spark, sf)).select("key")


@register("kv_4_delete_result", answer("key existed", "SELECT 'user:' || id AS key, id <> 0 AS existed FROM t_users WHERE age > 80"))
def _(spark, sf):
    return cache.existed(snapshot(spark, sf), _banned(spark, sf), LATER)


@register("kv_5_remaining_ttl", answer("key ttl_seconds:i", f"""
    SELECT key, date_diff('second', TIMESTAMP '{LATER}', expires_at) AS ttl_seconds FROM ({ENTRIES}) AS e
    WHERE expires_at > TIMESTAMP '{LATER}'"""))
def _(spark, sf):
    return cache.remaining_ttl(snapshot(spark, sf), LATER)


@register("kv_6_key_counts", answer("entity keys:i", f"SELECT entity, count(*) AS keys FROM ({ENTRIES}) AS e WHERE entity <> 'order' GROUP BY entity"))
def _(spark, sf):
    return cache.key_counts(snapshot(spark, sf), LATER)


@register("kv_7_load", answer("entity n:i first_expiry:ts", f"""
    SELECT entity, count(*) AS n, min(expires_at) AS first_expiry FROM ({ENTRIES}) AS e WHERE entity <> 'order' GROUP BY entity"""))
def _(spark, sf):
    """One of the three tables is missing and is skipped."""
    loaded = cache.load({**_entities(spark, sf), "order": None}, NOON)
    return loaded.groupBy("entity").agg(F.count("*").alias("n"), F.min("expires_at").alias("first_expiry"))


@register("kv_2_put_buckets", answer("key label expires_at:ts", f"""
    SELECT 'user:' || id AS key, CASE WHEN age > 70 THEN 'renamed ' || username ELSE username END AS label,
        CASE WHEN age > 70 THEN TIMESTAMP '{LATER}' ELSE TIMESTAMP '{NOON}' END + INTERVAL 1 HOUR AS expires_at
    FROM t_users WHERE id <> 0 AND (age > 80) IS NOT TRUE"""))
def _(spark, sf):
    """A stored snapshot: all users, changed ones over them, some deleted; the change is sent again and not applied twice."""
    ages = models.normalized(spark, sf)["users"].select("id", "age")
    users = _entities(spark, sf)["user"]
    changed = users.join(ages.filter("age > 70"), "id").drop("age").withColumn("username", F.concat(F.lit("renamed "), "username"))
    stored = Buckets(spark, scratch_path(spark, "buckets"), 32)
    stored.put(cache.entries(users, "user", NOON), "all", NOON)
    stored.put(cache.entries(changed, "user", LATER), "changed", LATER)
    stored.delete(_banned(spark, sf), "banned", LATER)
    stored.put(cache.entries(changed, "user", LATER), "changed", LATER)
    return stored.live(LATER).select("key", label(), "expires_at")


@register("kv_3_get_buckets", answer("key label", f"""
    SELECT key, label FROM ({ENTRIES}) AS e WHERE entity = 'user' AND id IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')"""))
def _(spark, sf):
    """The users of open orders from a stored snapshot."""
    stored = Buckets(spark, scratch_path(spark, "buckets"), 32)
    stored.put(snapshot(spark, sf), "all", NOON)
    open_orders = retail.table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    return stored.get_many(open_orders.select(F.concat(F.lit("user:"), F.col("o_custkey").cast("string")).alias("key")), LATER).select("key", label())
