import json
import os
import pathlib
import shutil

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from merchantry.plans import increments
from merchantry.sources import versions
from merchantry.sources.versions import Versions

SF_DIR = pathlib.Path("/root/testdata/sf0.001")


def tables(spark):
    users = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    orders = spark.createDataFrame([(10, 1), (11, 2), (12, 2)], "id long, user_id long")
    return {"orders": orders, "users": users}


def test_load_once(spark, tmp_path, rows):
    folder = str(tmp_path / "loaded")
    assert versions.load(tables(spark), folder, "monday") == ["users", "orders"]
    assert versions.load(tables(spark), folder, "monday") == []
    assert versions.load({"orders": tables(spark)["orders"].limit(0)}, folder, "empty") == ["orders"]
    assert versions.load({"orders": tables(spark)["orders"].filter("id = 10")}, folder, "tuesday/2") == ["orders"]
    assert rows(versions.read(spark, folder, "orders")) == [(10, 1), (10, 1), (11, 2), (12, 2)]
    assert rows(versions.loads(spark, folder)) == [("empty", 0, "orders", 0), ("monday", 0, "users", 2), ("monday", 1, "orders", 3), ("tuesday/2", 0, "orders", 1)]
    with pytest.raises(ValueError):
        versions.load({"users": tables(spark)["orders"]}, folder, "other columns")


def test_broken_load(spark, tmp_path, rows, monkeypatch):
    """A load that dies between two tables shows nothing; after a retry each row is there once, parents written first."""
    folder, written = str(tmp_path / "loaded"), []
    versions.load({"users": spark.createDataFrame([(0, "z")], "id long, name string")}, folder, "before")
    own = Versions.write

    def dies(self, load_id, name, df):
        written.append(name)
        if name == "orders" and written.count("orders") == 1:
            raise OSError("lost")
        return own(self, load_id, name, df)

    monkeypatch.setattr(Versions, "write", dies)
    with pytest.raises(OSError):
        versions.load(tables(spark), folder, "monday")
    assert rows(versions.read(spark, folder, "users")) == [(0, "z")]
    assert versions.load(tables(spark), folder, "monday") == ["users", "orders"]
    assert written == ["users", "orders", "users", "orders"]
    assert rows(versions.read(spark, folder, "users")) == [(0, "z"), (1, "a"), (2, "b")] and versions.read(spark, folder, "orders").count() == 3
    assert len(Versions(spark, folder).discard_unpublished()) == 1
    assert rows(versions.read(spark, folder, "users")) == [(0, "z"), (1, "a"), (2, "b")]


def test_two_writers(spark, tmp_path, rows, monkeypatch):
    """Of two writers that publish the same number one starts again from the other's version; neither is lost."""
    folder = str(tmp_path / "loaded")
    own, raced = Versions._publish, []

    def slow(self, state):
        if not raced:
            raced.append(1)
            versions.load({"users": spark.createDataFrame([(9, "first")], "id long, name string")}, folder, "other")
        return own(self, state)

    monkeypatch.setattr(Versions, "_publish", slow)
    assert versions.load(tables(spark), folder, "monday") == ["users", "orders"]
    assert rows(versions.read(spark, folder, "users")) == [(1, "a"), (2, "b"), (9, "first")]
    assert list(Versions(spark, folder).latest()["loads"]) == ["other", "monday"]
    assert sorted(os.listdir(f"{folder}/_versions"))[-2:] == ["000000000001.json", "000000000002.json"]


@pytest.fixture
def growing(tmp_path):
    """The given tables, the orders and lines in a folder of files: those up to a key, and what comes later."""
    if not SF_DIR.exists():
        pytest.skip("the given tables are not here")
    source = tmp_path / "source"
    source.mkdir()
    for name in ("region", "nation", "customer", "part"):
        shutil.copy(SF_DIR / f"{name}.parquet", source)
    parts = {name: pq.read_table(SF_DIR / f"{name}.parquet").to_pandas() for name in ("orders", "lineitem")}

    def put(name, key, keep, file):
        (source / f"{name}.parquet").mkdir(exist_ok=True)
        df = parts[name]
        df[keep(df[key])].to_parquet(source / f"{name}.parquet" / f"{file}.parquet", index=False)

    return source, put, int(parts["orders"]["o_orderkey"].quantile(0.99))


def spoil(source):
    """The files that are there can't be read any more, but look as they did."""
    for path in [*source.glob("orders.parquet/*"), *source.glob("lineitem.parquet/*")]:
        stat = path.stat()
        path.write_bytes(b"x" * stat.st_size)
        os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))


def same(rows, found, want):
    assert sorted(found) == sorted(want)
    for name in found:
        assert found[name].columns == want[name].columns, name
        assert rows(found[name]) == rows(want[name]), name


@pytest.mark.parametrize("model", ["star", "snowflake"])
def test_new_orders_only(spark, tmp_path, rows, growing, model):
    """The last hundredth of the orders is added: earlier files are not read, and all tables are those of a full build."""
    source, put, cut = growing
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        put(name, key, lambda k: k <= cut, "first")
    folder = str(tmp_path / "model")
    increments.update(spark, str(source), folder, model)
    assert Versions(spark, folder).latest()["notes"]["how"] == "built"
    before = increments.update(spark, str(source), folder, model)["fact_orders"].count()
    assert Versions(spark, folder).latest()["version"] == 1
    whole = {p: p.read_bytes() for p in source.rglob("*.parquet") if p.is_file()}
    spoil(source)
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        put(name, key, lambda k: k > cut, "second")
    grown = increments.update(spark, str(source), folder, model)
    assert Versions(spark, folder).latest()["notes"]["how"] == "extended" and grown["fact_orders"].count() > before
    for p, data in whole.items():
        p.write_bytes(data)
    full = increments.update(spark, str(source), str(tmp_path / "full"), model)
    same(rows, grown, full)


def test_late_and_early_lines(spark, tmp_path, rows, growing):
    """Lines that come after their order, and before it: sums are those of a full build; months of many parts are merged."""
    source, put, cut = growing
    folder = str(tmp_path / "model")
    put("orders", "o_orderkey", lambda k: k <= cut, "first")
    put("lineitem", "l_orderkey", lambda k: k % 3 != 0, "first")
    increments.update(spark, str(source), folder)
    assert increments.update(spark, str(source), folder)[increments.WAITING].count() > 0
    put("lineitem", "l_orderkey", lambda k: k % 3 == 0, "second")
    increments.update(spark, str(source), folder, most_parts=1)
    put("orders", "o_orderkey", lambda k: k > cut, "second")
    grown = increments.update(spark, str(source), folder, most_parts=1)
    full = increments.update(spark, str(source), str(tmp_path / "full"))
    assert Versions(spark, folder).latest()["notes"]["how"] == "extended" and grown[increments.WAITING].count() == 0
    assert sorted(rows(grown["fact_orders"].select("fact_id"))) == sorted(rows(full["fact_orders"].select("fact_id")))
    for name in (increments.ORDER_SUMS, increments.HEADS, "dim_date", "dim_location"):
        same(rows, {name: grown[name]}, {name: full[name]})
    same(rows, {"f": grown["fact_orders"].drop("fact_id")}, {"f": full["fact_orders"].drop("fact_id")})
    months = [increments.month_of(p) for p in Versions(spark, folder).latest()["tables"]["fact_orders"]["parts"]]
    assert len(months) == len(set(months))
    Versions(spark, folder).discard_unpublished()
    same(rows, {"f": grown["fact_orders"].drop("fact_id")}, {"f": full["fact_orders"].drop("fact_id")})


def test_other_changes_build_anew(spark, tmp_path, rows, growing):
    source, put, cut = growing
    folder = str(tmp_path / "model")
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        put(name, key, lambda k: k <= cut, "first")
    increments.update(spark, str(source), folder)
    early = pq.read_table(SF_DIR / "orders.parquet").slice(0, 1).to_pandas()
    early["o_orderdate"], early["o_orderkey"] = pd.Timestamp("1980-05-01"), 10**9
    early.to_parquet(source / "orders.parquet" / "early.parquet", index=False, coerce_timestamps="us")
    years = increments.update(spark, str(source), folder)["dim_date"].agg(F.min("year")).first()[0]
    assert Versions(spark, folder).latest()["notes"]["how"] == "built" and years < 1990
    customers = pq.read_table(SF_DIR / "customer.parquet").to_pandas()
    customers.head(100).to_parquet(source / "customer.parquet", index=False)
    assert increments.update(spark, str(source), folder)["dim_users"].count() == 100
    assert json.loads(sorted(pathlib.Path(folder, "_versions").glob("*.json"))[-1].read_text())["notes"]["how"] == "built"
