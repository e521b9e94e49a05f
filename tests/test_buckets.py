"""The snapshot in buckets: what a change touches, what a reader reads, expiry, repeats and writers at once."""

import pytest
from pyspark.sql import functions as F

from merchantry.operators import cache
from merchantry.sources import buckets
from merchantry.sources.buckets import Buckets

NOON, LATER, EVENING = "2025-01-01 12:00:00", "2025-01-01 12:45:00", "2025-01-01 18:00:00"


def users(spark, ids, label="u"):
    return spark.createDataFrame([(i, f"{label}{i}") for i in ids], "id long, username string")


def entries(spark, ids, at=NOON, label="u"):
    return cache.entries(users(spark, ids, label), "user", at)


def held(df):
    return {r.key: r.value for r in df.collect()}


def parts(stored):
    return set(stored.versions.latest()["tables"]["entries"]["parts"])


@pytest.fixture
def stored(spark, tmp_path):
    stored = Buckets(spark, str(tmp_path / "cache"), 16)
    assert stored.put(entries(spark, range(1, 1001)), "first", NOON)
    return stored


def test_a_change_rewrites_the_buckets_it_touches(spark, stored):
    before = parts(stored)
    assert len(before) == 16 and stored.live(NOON).count() == 1000
    assert stored.put(entries(spark, [5, 2000], label="new"), "second", LATER)
    after = parts(stored)
    assert len(after) == 16 and len(before - after) <= 2
    found = held(stored.live(LATER))
    assert len(found) == 1001 and "new5" in found["user:5"] and "u6" in found["user:6"]
    before = parts(stored)
    assert stored.delete(spark.createDataFrame([("user:5",), ("none",), (None,)], "key string"), "third", LATER)
    assert len(before - parts(stored)) <= 2 and set(held(stored.live(LATER))) == set(found) - {"user:5"}


def test_a_read_opens_the_buckets_of_its_keys(spark, stored):
    one = stored.get("user:7", LATER)
    assert len({f.rsplit("/", 2)[-2] for f in one.inputFiles()}) == 1 and list(held(one)) == ["user:7"]
    assert stored.get("user:7", EVENING).count() == 0 and stored.get("user:0", NOON).count() == 0
    keys = spark.createDataFrame([("user:7",), ("user:7",), ("user:8",), ("none",)], "key string")
    many = stored.get_many(keys, LATER)
    assert len({f.rsplit("/", 2)[-2] for f in many.inputFiles()}) <= 3 and set(held(many)) == {"user:7", "user:8"}


def test_a_load_is_applied_once(spark, stored):
    assert stored.delete(spark.createDataFrame([("user:1",)], "key string"), "gone", NOON)
    before = parts(stored)
    assert not stored.put(entries(spark, range(1, 1001)), "first", NOON)
    assert parts(stored) == before and stored.get("user:1", NOON).count() == 0


def test_expired_entries_go_with_the_rewrite(spark, tmp_path):
    stored = Buckets(spark, str(tmp_path / "cache"), 1)
    stored.put(entries(spark, [1, 2]), "first", NOON)
    stored.put(entries(spark, [3], at=EVENING), "second", EVENING)
    assert set(held(stored.live(NOON))) == {"user:3"}
    # the number of buckets is that of the folder
    again = Buckets(spark, str(tmp_path / "cache"), 8)
    again.delete(spark.createDataFrame([("user:3",)], "key string"), "third", EVENING)
    assert again.live(NOON).count() == 0 and again.get("user:3", NOON).count() == 0
    again.put(entries(spark, [4]), "fourth", NOON)
    assert set(held(again.live(NOON))) == {"user:4"} and len(parts(again)) == 1


def test_nothing_put_and_nothing_there(spark, tmp_path):
    stored = Buckets(spark, str(tmp_path / "cache"))
    assert stored.live(NOON).count() == 0 and stored.get("user:1", NOON).count() == 0
    assert stored.delete(spark.createDataFrame([("user:1",)], "key string"), "nothing", NOON)
    assert stored.put(entries(spark, [1]).limit(0), "empty", NOON) and stored.live(NOON).count() == 0


def test_two_writers_of_one_bucket(spark, tmp_path, monkeypatch):
    """The second one starts again from what the first has written."""
    folder = str(tmp_path / "cache")
    Buckets(spark, folder, 1).put(entries(spark, [1, 2]), "first", NOON)
    slow, other = Buckets(spark, folder), Buckets(spark, folder)
    commit, once = slow.versions.commit, []

    def late(load_id, change):
        if not once:
            once.append(other.put(entries(spark, [3]), "between", NOON))
        return commit(load_id, change)

    monkeypatch.setattr(slow.versions, "commit", late)
    assert slow.put(entries(spark, [2], label="new"), "second", NOON)
    found = held(slow.live(NOON))
    assert set(found) == {"user:1", "user:2", "user:3"} and "new2" in found["user:2"]


def test_buckets_are_the_same_in_spark_and_python(spark):
    keys = ["", "user:1", "größe", "日本"]
    got = spark.createDataFrame([(k,) for k in keys], "key string").select(buckets._bucket(F.col("key"), 256)).collect()
    assert [r[0] for r in got] == [buckets.zlib.crc32(k.encode()) % 256 for k in keys]
