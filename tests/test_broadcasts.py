"""What a query broadcasts: never the rows or keys of a table that grows."""

import pytest

from merchantry import schemas
from merchantry.functions.numbering import id_by_key
from merchantry.operators import dimensions as d
from merchantry.plans import snowy, starry
from merchantry.sources.store import settle

N = 3000


def broadcast_rows(df):
    """The rows of each broadcast that a frame has run."""
    df.collect()
    sizes, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "BroadcastExchange":
            sizes.append(node.metrics().apply("numOutputRows").value())
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return sizes


def made(spark, table, *columns):
    return settle(schemas.conform_to(spark.range(1, N + 1).selectExpr("id", *columns), "normalized", table))


@pytest.fixture(scope="module")
def t(spark):
    """Users, addresses and products of the same number, every user with an address, two months of orders."""
    place = "concat('c', cast(id % 3 AS string))"
    return {
        "users": made(spark, "users", "concat('u', id) AS username", "'user' AS role", "id AS address_id"),
        "addresses": made(spark, "addresses", f"{place} AS city", "'Ohio' AS state", "'OH' AS state_code", "'1' AS postal_code"),
        "categories": settle(schemas.conform_to(spark.range(1, 3).selectExpr("id", "concat('n', id) AS name", "concat('s', id) AS slug"), "normalized", "categories")),
        "products": made(spark, "products", "concat('p', id) AS title", "id % 2 + 1 AS category_id", "'B' AS brand", "1.0 AS price"),
        "orders": made(spark, "orders", "id AS user_id", "timestamp_ntz '2024-02-01 10:00:00' - make_dt_interval(id % 40) AS order_date", "'F' AS status"),
        "order_items": made(spark, "order_items", "id AS order_id", f"{N} + 3 - id AS product_id", "2 AS quantity", "3.0 AS price"),
    }


def kept(name, df):
    return settle(df)


def want(first):
    """The newest lines: 40 days, a day has every 40th order; products of the first two lines are unknown."""
    lines = sorted(((i % 40, i) for i in range(3, N + 1)))[:first]
    return sorted(((i, f"u{i}", f"p{N + 3 - i}", f"n{(N + 3 - i) % 2 + 1}", f"c{i % 3}", 2) for _, i in lines), key=repr)


def test_wide_join_of_a_snowflake_broadcasts_no_dimension(spark, t, rows):
    df = snowy.wide_join(d.build_snowflake(t, keep=kept), 20)
    assert rows(df.select("order_id", "username", "product_name", "category_name", "city_name", "quantity")) == want(20)
    assert max(broadcast_rows(df)) < N


def test_users_of_a_snowflake_broadcast_no_addresses(spark, t):
    m = d.build_snowflake(t, keep=kept)
    df = d.snow_users(t, m["dim_user_roles"], m["dim_states"], m["dim_cities"])
    assert df.count() == N and max(broadcast_rows(df)) < N


def test_newest_facts_broadcast_no_keys(spark, t):
    m = d.build_star(t, keep=kept)
    df = starry.newest_facts({**m, "fact_orders": settle(m["fact_orders"])}, 20)
    assert df.count() == 20 and max(broadcast_rows(df)) < N


def test_numbering_broadcasts_no_rows(spark, t):
    df = id_by_key(t["addresses"].select("id", "city"), "id", "n")
    assert [tuple(r) for r in df.selectExpr("count(*)", "count_if(id = n)").collect()] == [(N, N)]
    assert max(broadcast_rows(df), default=0) < N


def test_wide_join_of_a_star_broadcasts_no_dimension(spark, t, rows):
    df = starry.wide_join(d.build_star(t, keep=kept), 20)
    assert rows(df.select("order_id", "username", "product_name", "category", "city", "quantity")) == want(20)
    assert max(broadcast_rows(df)) < N


def test_places_of_users_are_found_without_a_broadcast_of_users_or_addresses(spark, t):
    df = d.user_places(t, d.build_star(t, keep=kept)["dim_location"])
    assert [tuple(r) for r in df.selectExpr("count(*)", "count_if((user_id - 1) % 3 + 1 = location_id)").collect()] == [(N, N)]
    assert max(broadcast_rows(df), default=0) < N
