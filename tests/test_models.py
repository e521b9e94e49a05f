"""Dimensions, facts and the analytic queries on hand-made rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from merchantry import schemas
from merchantry.functions.money import half_up, mean_money, percent_of
from merchantry.functions.regions import region_of
from merchantry.operators import dimensions as d
from merchantry.operators import documents
from merchantry.plans import common, models, relational, snowy, starry
from merchantry.sources import store


def make(spark, table, columns, data):
    dtypes = {f.name: f.dataType.simpleString() for f in schemas.schema_of("normalized", table).fields}
    df = spark.createDataFrame(data, ", ".join(f"{c} {dtypes[c]}" for c in columns.split()))
    return schemas.conform_to(df, "normalized", table)


def money(*values):
    return [Decimal(str(v)) for v in values]


@pytest.fixture(scope="module")
def t(spark):
    ts = lambda s: dt.datetime.fromisoformat(s)
    m = lambda v: None if v is None else Decimal(str(v))
    tables = {
        "users": make(spark, "users", "id first_name last_name username role address_id", [
            (1, "Ann", "Lee", "ann", "admin", 1), (2, "Bob", None, "bob", None, 2), (3, None, None, "cy", "", 3), (4, "Di", "X", "di", "buyer", None)]),
        "addresses": make(spark, "addresses", "id city state state_code postal_code", [
            (1, "Reno", "Nevada", "NV", "1"), (2, "Reno", "NEVADA", "NV", "1"), (3, "Ulm", "Elsewhere", "ZZ", None), (4, "", "Ohio", "OH", "4")]),
        "categories": make(spark, "categories", "id name slug", [(1, "Tools", "tools"), (2, "Toys", "toys")]),
        "products": make(spark, "products", "id title category_id brand price stock", [
            (1, "Saw", 1, "B1", m(100), 5), (2, "Ball", 2, "", m(60), 50), (3, "Odd", 9, None, m(5), 20), (4, "Axe", 1, "B2", m(70), 11)]),
        "orders": make(spark, "orders", "id user_id order_date status total discounted_total total_quantity", [
            (1, 1, ts("2024-03-01T10:00:00"), "completed", m(30), m(27), 3), (2, 2, ts("2024-03-01T23:00:00"), None, m(50), m(45), 2),
            (3, 1, ts("2024-12-31T00:00:00"), "pending", m(20.55), m(20), 1), (4, 9, ts("2031-01-05T08:00:00"), "pending", m(9), m(9), 1),
            (5, 3, ts("2024-12-31T00:00:01"), "pending", m(7), m(7), 0)]),
        "order_items": make(spark, "order_items", "id order_id product_id quantity price discount_percentage total", [
            (1, 1, 1, 2, m(10.05), m(12.5), m(20.1)), (2, 1, 2, 1, m(9.99), None, m(9.99)), (3, 2, 4, 2, m(25), m(0), m(50)),
            (4, 3, 1, 1, m(20.55), m(33.33), m(20.55)), (5, 4, 3, 1, m(9), m(0), m(9)), (6, 77, 1, 1, m(1), m(0), m(1))]),
    }
    return {n: df.coalesce(1).cache() for n, df in tables.items()}


def test_calendar(spark):
    days = {r.full_date: r for r in d.date_dimension(spark).collect()}
    assert len(days) == 2557 and sorted(r.date_id for r in days.values()) == list(range(1, 2558))
    for day, r in days.items():
        iso = day.isocalendar()
        assert (r.year, r.month, r.day, r.day_of_week, r.week_of_year) == (day.year, day.month, day.day, day.isoweekday(), iso[1])
        assert (r.month_name, r.day_name) == (day.strftime("%B"), day.strftime("%A"))
        assert r.quarter == (day.month - 1) // 3 + 1 and r.is_weekend == (day.weekday() >= 5)
        assert r.is_holiday == ((day.month, day.day) in {(1, 1), (7, 4), (12, 25)})
        assert r.fiscal_year == day.year + (day.month >= 10) and r.fiscal_quarter == (day.month - 10) % 12 // 3 + 1


def test_regions(spark, rows):
    df = spark.createDataFrame([("NY",), ("FL",), ("OH",), ("TX",), ("HI",), ("PR",), ("",), (None,), ("ny",)], "c string")
    got = {r.c: r.r for r in df.select("c", region_of("c").alias("r")).collect()}
    assert got == {"NY": "Northeast", "FL": "Southeast", "OH": "Midwest", "TX": "Southwest", "HI": "West", "PR": "Other",
                   "": "Other", None: "Other", "ny": "Other"}


def test_half_up(spark):
    cases = [(5, 2, 3), (-5, 2, -3), (4, 3, 1), (-4, 3, -1), (7, 0, None), (0, 5, 0), (10**20, 3, None)]
    df = spark.createDataFrame([(Decimal(n), Decimal(x)) for n, x, _ in cases[:-1]], "n decimal(38,0), d decimal(38,0)")
    assert [r[0] for r in df.select(half_up(F.col("n"), F.col("d"))).collect()] == [w for *_, w in cases[:-1]]
    sums = spark.createDataFrame([(Decimal("10.05"), 2, Decimal("4.00"))], "s decimal(22,2), n bigint, w decimal(22,2)")
    got = sums.select(mean_money("s", "n"), percent_of("s", "w")).first()
    assert tuple(got) == (Decimal("5.03"), Decimal("251.25"))


def test_users_dimension(t, rows):
    assert rows(d.star_users(t), "user_id", "full_name", "role") == [(1, "Ann Lee", "admin"), (2, "Bob", "user"), (3, "", ""), (4, "Di X", "buyer")]


def test_products_dimension(t, rows):
    assert rows(d.star_products(t), "product_id", "category") == [(1, "Tools"), (2, "Toys"), (3, "Unknown"), (4, "Tools")]


def test_locations_are_not_merged_but_looked_up_by_place(t, rows):
    locations = d.star_locations(t)
    assert rows(locations, "location_id", "city", "region") == [(1, "Reno", "West"), (2, "Reno", "West"), (3, "Ulm", "Other"), (4, "", "Midwest")]
    assert rows(d.address_locations(t["addresses"], locations)) == [(1, 1), (2, 1), (4, 4)]


def test_star_fact(t):
    fact = {r.fact_id: r for r in d.build_star(t, 2020, 2026)["fact_orders"].collect()}
    assert set(fact) == {1, 2, 3, 4, 5}
    # 20.10 * 12.5 % = 2.5125; 20.55 * 33.33 % = 6.849315
    assert [fact[1][c] for c in ("subtotal", "discount_amount", "total_amount")] == money("20.10", "2.51", "17.59")
    assert [fact[4][c] for c in ("subtotal", "discount_amount", "total_amount")] == money("20.55", "6.85", "13.70")
    assert fact[2].discount_percentage == 0 and fact[2].total_amount == Decimal("9.99")
    assert fact[3].order_status == "pending" and fact[5].date_id == 20310105
    unknown = {**t, "orders": t["orders"].withColumn("status", F.lit(None).cast("string"))}
    assert {r.order_status for r in d.build_star(unknown)["fact_orders"].collect()} == {"completed"}
    assert fact[1].date_id == (dt.date(2024, 3, 1) - dt.date(2020, 1, 1)).days + 1
    assert [fact[i].location_id for i in (1, 3, 5)] == [1, 1, None]


def test_snowflake(t, rows):
    m = d.build_snowflake(t)
    assert rows(m["dim_user_roles"]) == [
        (1, "user", "Regular user"), (2, "admin", "Administrator"), (3, "moderator", "Moderator"), (4, "guest", "Guest user"),
        (5, "buyer", "User role")]
    assert rows(m["dim_states"], "state_id", "state_name", "state_code", "region") == [
        (1, "NEVADA", "NV", "West"), (2, "Elsewhere", "ZZ", "Other"), (3, "Ohio", "OH", "Midwest")]
    assert rows(m["dim_cities"], "city_id", "city_name", "state_id") == [(1, "Reno", 1), (2, "Ulm", 2)]
    assert rows(m["dim_brands"], "brand_id", "brand_name") == [(1, "B1"), (2, "B2")]
    assert rows(m["dim_users"], "user_id", "role_id", "city_id") == sorted([(1, 2, 1), (2, 1, 1), (3, None, 2), (4, 5, None)], key=repr)
    assert rows(m["dim_products"], "product_id", "category_id", "brand_id") == sorted([(1, 1, 1), (2, 2, None), (3, None, None), (4, 1, 2)], key=repr)


def test_slugs_are_unique_and_the_first_wins(spark, t, rows):
    doubled = make(spark, "categories", "id name slug", [(5, "Late", "tools"), (2, "Toys", "toys"), (1, "Tools", "tools")])
    assert rows(d.snow_categories({"categories": doubled}), "category_id", "category_name") == [(1, "Tools"), (2, "Toys")]


def test_order_lines_keep_order_and_skip_orphans(t):
    got = relational.order_lines(t, 3).collect()
    assert [(r.order_id, r.product_name) for r in got] == [(3, "Saw"), (2, "Axe"), (1, "Saw")]
    assert got[0].full_name == "Ann Lee" and got[1].full_name == "Bob " and got[0].category == "Tools"


def test_newest_lines(t):
    """Order 4 is newest but has no known user."""
    for n in (2, 9):
        assert [r.item_id for r in relational.newest_lines(t, n).collect()] == [4, 3, 1, 2][:n]
    star = d.build_star(t, 2020, 2031)
    for n in (2, 9):
        assert [r.fact_id for r in starry.newest_facts(star, n).collect()] == [4, 1, 2, 3][:n]


def test_revenue_by_user_counts_order_totals_per_line(t):
    got = {r.user_id: r for r in relational.revenue_by_user(t).collect()}
    assert set(got) == {1, 2}
    assert (got[1].total_orders, got[1].total_items, got[1].total_quantity) == (2, 3, 4)
    assert got[1].total_discounted_revenue == Decimal("74.00") and got[1].avg_order_value == Decimal("26.85")
    assert {r.user_id: r.total_revenue for r in relational.revenue_by_user_per_order(t).collect()}[1] == Decimal("50.55")


def test_orders_by_day(t):
    got = {str(r.order_date): r for r in relational.orders_by_day(t, "2024-01-01", "2024-12-31").collect()}
    assert set(got) == {"2024-03-01", "2024-12-31"}
    assert got["2024-03-01"].orders_count == 2 and got["2024-03-01"].top_category == "Tools"
    # the order one second after midnight is past the bound
    assert got["2024-12-31"].orders_count == 1 and got["2024-12-31"].daily_revenue == Decimal("20.55")


def test_models_agree(t, rows):
    star, snow = d.build_star(t), d.build_snowflake(t)
    for query in (starry.user_ranking, starry.monthly_revenue, starry.heavy_aggregate):
        assert rows(query(star)) == rows(query(snow))
    measures = ["product_id", "total_orders", "total_quantity", "total_revenue"]
    assert rows(starry.product_ranking(star), *measures) == rows(snowy.product_ranking(snow), *measures)
    # regions of the star follow locations, those of the snowflake cities; the totals are the same where both know the place
    by_city = {r.city_name: r.city_revenue for r in snowy.revenue_by_city(snow).collect()}
    by_location = {r.city: r.total_revenue for r in starry.revenue_by_location(star).collect()}
    assert by_city["Reno"] == by_location["Reno"]


def test_growth_and_share(spark, t):
    star, snow = d.build_star(t), d.build_snowflake(t)
    months = {(r.year, r.month): r for r in starry.monthly_growth(star).collect()}
    march, december = months[(2024, 3)], months[(2024, 12)]
    assert march.prev_month_revenue is None and march.revenue_growth_percent is None and march.unique_customers == 2
    assert december.prev_month_revenue == Decimal("77.58") and december.revenue_growth_percent == Decimal("-82.34")
    shares = {r.category_slug: r for r in snowy.category_performance(snow).collect()}
    assert set(shares) == {"tools", "toys"} and sum(r.market_share_percent for r in shares.values()) == 100
    assert shares["tools"].top_brand == "B2" and shares["toys"].top_brand is None and shares["tools"].orders_count == 3
    star_rows = {r.category: r for r in starry.category_performance(star).collect()}
    assert star_rows["Tools"].products_in_category == 2 and star_rows["Unknown"].top_brand is None


def test_null_region_is_a_group(t):
    users = t["users"].withColumn("address_id", F.when(F.col("id") != 2, F.col("address_id")))
    got = {r.region: r for r in snowy.revenue_by_region(d.build_snowflake({**t, "users": users})).collect()}
    assert got[None].customers_in_region == 1 and got[None].cities_in_region == 0 and got["West"].total_orders == 2


def test_filtered(t):
    assert [r.id for r in relational.filtered_products(t).collect()] == [2, 4]


@pytest.mark.parametrize("query", [starry.category_performance, starry.top_users, starry.revenue_by_region])
def test_partitioning_does_not_matter(spark, t, rows, query):
    results = []
    for partitions in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        shuffled = {n: df.repartition(int(partitions) + 1) for n, df in t.items()}
        results.append(rows(query(d.build_star(shuffled))))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


def test_a_third_of_all_lines_in_one_order_and_product(spark, rows):
    """Facts and order documents of skewed tables against plain Python."""
    lines = 9000
    order_of = lambda i: 1 if i % 3 == 0 else i % 700 + 2
    product_of = lambda i: 5 if i % 3 == 1 else i % 40
    items = spark.range(1, lines + 1).selectExpr(
        "id", "IF(id % 3 = 0, 1, id % 700 + 2) AS order_id", "IF(id % 3 = 1, 5, id % 40) AS product_id",
        "CAST(id % 9 + 1 AS INT) AS quantity", "2.50 AS price", "0 AS discount_percentage",
    )
    tables = {
        "order_items": schemas.conform_to(items, "normalized", "order_items"),
        "orders": schemas.conform_to(spark.range(1, 702).selectExpr(
            "id", "id % 50 AS user_id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS order_date"), "normalized", "orders"),
        "users": schemas.conform_to(spark.range(50), "normalized", "users"),
        "products": schemas.conform_to(spark.range(40).selectExpr("id", "concat('p', id) AS title", "1 AS category_id"), "normalized", "products"),
        "categories": make(spark, "categories", "id name slug", [(1, "All", "all")]),
        "addresses": make(spark, "addresses", "id city", [(1, "x")]),
    }
    fact = d.build_star(tables)["fact_orders"]
    revenue = {}
    for i in range(1, lines + 1):
        revenue[product_of(i)] = revenue.get(product_of(i), 0) + (i % 9 + 1) * Decimal("2.50")
    assert dict(rows(fact.groupBy("product_id").agg(F.sum("total_amount")))) == revenue
    docs = documents.order_documents(tables, limit=500).orderBy("_id", "part").collect()
    assert documents.order_documents(tables).filter("_id = 7").count() == 1 and "part" not in documents.order_documents(tables).columns
    whole = {}
    for r in docs:
        whole.setdefault(r["_id"], []).extend(line.product_id for line in r["items"])
    want = {k: [product_of(i) for i in range(1, lines + 1) if order_of(i) == k] for k in range(1, 702)}
    assert whole == want and max(len(r["items"]) for r in docs) <= 1000


def test_a_query_builds_the_tables_it_reads(spark, tmp_path):
    """Tables given as functions are built when they are asked for, once, from those that they ask for; not from changed files."""
    (tmp_path / "data").mkdir()
    source, built = str(tmp_path / "data"), []
    spark.range(3).write.parquet(f"{source}/a.parquet")

    def build(keep):
        def step(name, make):
            return lambda m: built.append(name) or make(m)
        return {"a": step("a", lambda m: spark.read.parquet(f"{source}/a.parquet")), "b": step("b", lambda m: m["a"].filter("id > 0")),
                "c": step("c", lambda m: m["a"]), "d": step("d", lambda m: m["a"])}

    m = store.stored(spark, source, "steps", build)
    assert list(m) == ["a", "b", "c", "d"] and "b" in m and "e" not in m and built == []
    assert m["b"].count() == 2 and built == ["b", "a"] and store.stored(spark, source, "steps", build)["b"] is m["b"]
    spark.range(5).write.mode("append").parquet(f"{source}/a.parquet")
    with pytest.raises(RuntimeError, match="have changed"):
        m["c"]
    assert sorted(name for name, _ in store.stored(spark, source, "steps", build).items()) == ["a", "b", "c", "d"]
    store.release(spark, source)


@pytest.mark.parametrize("model", ["star", "snowflake"])
def test_questions_about_products_number_no_line(spark, tmp_path, model):
    """The same rows before and after the fact rows are built, with a repeated order, a repeated line and nulls."""
    folder = str(tmp_path)
    one, some = spark.range(1), spark.range(1, 7)
    orders = some.selectExpr("id AS o_orderkey", "id % 3 + 1 AS o_custkey", "date '2024-12-30' + CAST(id AS INT) AS o_orderdate",
                             "'F' AS o_orderstatus", "id * 100.5D AS o_totalprice")
    lines = some.crossJoin(spark.range(1, 4).toDF("n")).selectExpr(
        "nullif(id, 5) AS l_orderkey", "nullif((id + n) % 4 + 1, 4) AS l_partkey", "1L AS l_suppkey", "CAST(n AS INT) AS l_linenumber",
        "CAST(n AS DOUBLE) AS l_quantity", "id * 10.25D AS l_extendedprice", "0.05D AS l_discount", "0.0D AS l_tax", "'N' AS l_returnflag",
        "'O' AS l_linestatus", "date '2025-01-05' AS l_shipdate")
    for name, rows in {
        "region": one.selectExpr("0 AS r_regionkey", "'EUROPE' AS r_name"),
        "nation": one.selectExpr("0 AS n_nationkey", "'FRANCE' AS n_name", "0 AS n_regionkey"),
        "customer": spark.range(1, 4).selectExpr("id AS c_custkey", "concat('Customer#', id) AS c_name", "id * 600.0D AS c_acctbal",
                                                 "0 AS c_nationkey", "'BUILDING' AS c_mktsegment"),
        "part": spark.range(1, 5).selectExpr("id AS p_partkey", "'red nut' AS p_name", "concat('Brand#', id) AS p_brand", "'TIN' AS p_type",
                                             "CAST(id * 10 AS INT) AS p_size", "id * 9.5D AS p_retailprice"),
        "orders": orders.unionByName(orders.filter("o_orderkey = 2")).unionByName(orders.limit(1).selectExpr(
            "CAST(NULL AS BIGINT) AS o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")),
        "lineitem": lines.unionByName(lines.filter("l_orderkey = 3")),
    }.items():
        rows.write.parquet(f"{folder}/{name}.parquet")
    m = getattr(models, model)(spark, folder)
    query = {"star": starry, "snowflake": snowy}[model].category_performance
    before = [query(m).collect(), starry.heavy_aggregate(m).collect()]
    assert not m.built("fact_orders") and not models.normalized(spark, folder).built("order_items")
    assert len(m["fact_orders"].head(1)) == 1 and m.built("fact_orders")
    assert before == [query(m).collect(), starry.heavy_aggregate(m).collect()]
    store.release(spark, folder)


def test_order_totals_are_the_facts_of_each_order(t, rows):
    """Also of orders and users that come twice."""
    twice = {**t, "orders": t["orders"].union(t["orders"].filter("id < 3")), "users": t["users"].union(t["users"].filter("id = 2"))}
    for tables in (t, twice):
        star, flake = d.build_star(tables, 2020, 2026), d.build_snowflake(tables, 2020, 2026)
        for model, m, places in (("star", star, d.user_places(tables, star["dim_location"])), ("snowflake", flake, None)):
            got = d.order_totals(tables, m["dim_date"], model, places)
            want = common.order_sums({"fact_orders": m["fact_orders"]})
            assert rows(got, *want.columns) == rows(want) and dict(got.dtypes) == dict(want.dtypes)


def test_orders_without_lines_moved(t):
    """Locations are looked up for orders: the plan of the facts has no join of lines by user."""
    plan = d.build_star(t, 2020, 2026)["fact_orders"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Join LeftOuter")


def test_stored_models_follow_their_files(spark, tmp_path):
    """A file changed in the session is read anew; released models leave no files."""
    from merchantry.sources import store

    source = str(tmp_path / "source")
    build = lambda keep: {"t": keep("t", spark.read.parquet(source).selectExpr("id * 2 AS d"))}
    spark.range(3).write.parquet(source)
    assert store.stored(spark, source, "m", build)["t"].count() == 3
    spark.range(5).write.mode("overwrite").parquet(source)
    again = store.stored(spark, source, "m", build)["t"]
    assert again.count() == 5 and store.stored(spark, source, "m", build)["t"] is again
    root = store._models[spark.sparkContext.applicationId, source, "m"][0]
    assert store.remove(spark, root + "-none") is None
    store.release(spark, source)
    import pathlib
    assert not pathlib.Path(root).exists()


def test_calendar_follows_the_orders(spark):
    orders = spark.sql("SELECT TIMESTAMP_NTZ '1988-05-01 10:00:00' AS order_date UNION ALL SELECT TIMESTAMP_NTZ '2031-02-03 00:00:00'")
    days = d.calendar_of(orders)
    assert days.count() == 16071 and days.filter("date_id = 1").first().full_date.isoformat() == "1988-01-01"
    assert d.calendar_of(orders.limit(0)).count() == 0


def test_latest_periods_read_only_their_months(spark):
    import pathlib

    from merchantry.plans import models, starry

    sf = "/root/testdata/sf0.001"
    if not pathlib.Path(sf).exists():
        pytest.skip("the given tables are not here")
    m = models.star(spark, sf)
    for query in (starry.daily_revenue, starry.weekly_revenue):
        plan = query(m)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(month_id" in plan
    for query in (starry.revenue_by_region, starry.heavy_aggregate):
        assert "Expand" not in query(m)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("model", ["star", "snowflake"])
def test_facts_are_dealt_by_month_without_amounts(spark, monkeypatch, t, rows, model):
    """Rows move before their amounts are computed; they equal the facts of a model that is not stored."""
    whole = {"star": d.build_star, "snowflake": d.build_snowflake}[model](t)
    monkeypatch.setattr(models, "normalized", lambda *_: t)
    monkeypatch.setattr(models.retail, "table", lambda *_: None)
    monkeypatch.setattr(models.retail, "order_keys", lambda _: t["orders"])
    monkeypatch.setattr(models.retail, "plain_items", lambda *_: t["order_items"])
    fact = models.laid_out(spark, "", model)["fact_orders"](whole)
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    assert fact._dealt and plan.count("RebalancePartitions") == 1
    assert "AS total_amount" in plan.split("RebalancePartitions")[0] and "AS total_amount" not in plan.split("RebalancePartitions")[1]
    assert rows(fact, *whole["fact_orders"].columns) == rows(whole["fact_orders"])
    assert fact.filter(F.col(store.MONTH).isNull()).count() == 0 and {*fact.columns} == {*whole["fact_orders"].columns, store.MONTH}


@pytest.mark.parametrize("twice", [False, True])
def test_snowflake_reads_the_facts_of_a_star(spark, tmp_path, rows, twice):
    """Lines are laid out once for both models; not if a user that comes twice, in two places, doubles the lines of the star."""
    folder = str(tmp_path)
    one, some = spark.range(1), spark.range(1, 7)
    users = spark.range(1, 4).selectExpr("id AS c_custkey", "concat('Customer#', id) AS c_name", "id * 600.0D AS c_acctbal",
                                         "0 AS c_nationkey", "'BUILDING' AS c_mktsegment")
    for name, df in {
        "region": one.selectExpr("0 AS r_regionkey", "'EUROPE' AS r_name"),
        "nation": one.selectExpr("0 AS n_nationkey", "'FRANCE' AS n_name", "0 AS n_regionkey"),
        "customer": users.unionByName(users.filter("c_custkey = 2").withColumn("c_acctbal", F.lit(9000.0))) if twice else users,
        "part": spark.range(1, 5).selectExpr("id AS p_partkey", "'red nut' AS p_name", "concat('Brand#', id) AS p_brand", "'TIN' AS p_type",
                                             "CAST(id * 10 AS INT) AS p_size", "id * 9.5D AS p_retailprice"),
        "orders": some.selectExpr("id AS o_orderkey", "nullif(id % 5 + 1, 5) AS o_custkey", "date '2024-12-30' + CAST(id AS INT) AS o_orderdate",
                                  "'F' AS o_orderstatus", "id * 100.5D AS o_totalprice"),
        "lineitem": some.crossJoin(spark.range(1, 4).toDF("n")).selectExpr(
            "id AS l_orderkey", "nullif((id + n) % 4 + 1, 4) AS l_partkey", "1L AS l_suppkey", "CAST(n AS INT) AS l_linenumber",
            "CAST(n AS DOUBLE) AS l_quantity", "id * 10.25D AS l_extendedprice", "0.05D AS l_discount", "0.0D AS l_tax", "'N' AS l_returnflag",
            "'O' AS l_linestatus", "date '2025-01-05' AS l_shipdate"),
    }.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    want = d.build_snowflake(models.normalized(spark, folder))["fact_orders"]
    expected = rows(want)
    star, flake = models.star(spark, folder)["fact_orders"], models.snowflake(spark, folder)["fact_orders"]
    assert {*flake.columns} == {*want.columns, store.MONTH} and rows(flake, *want.columns) == expected
    assert (set(flake.inputFiles()) == set(star.inputFiles())) is not twice and (star.count() > want.count()) is twice
    store.release(spark, folder)
    alone = models.snowflake(spark, folder)["fact_orders"]
    assert rows(alone, *want.columns) == expected and alone.columns == flake.columns
    assert not models.star(spark, folder).built("fact_orders")
    store.release(spark, folder)
