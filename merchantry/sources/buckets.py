"""The keyed snapshot in a folder: entries lie in buckets by a hash of their key, and a change rewrites the buckets it touches.

Every change is a commit of ``versions``: readers see it whole or not at all, and a load id that is committed is not applied again.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchantry.operators import cache
from merchantry.sources.versions import Versions, replace

TABLE, BUCKET, NUMBER = "entries", "bucket", "buckets"


class _Moved(Exception):
    """Another writer has changed a bucket since it was read."""


class Buckets:
    """A snapshot in ``folder``; ``buckets`` counts when the folder is new and is remembered there."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 256):
        self.spark, self.versions, self._new = spark, Versions(spark, folder), buckets

    def _number(self, state: dict) -> int:
        return state["notes"].get(NUMBER, self._new)

    def _parts(self, state: dict, touched: set[int] | None = None) -> list[str]:
        parts = state["tables"].get(TABLE, {"parts": []})["parts"]
        return [p for p in parts if touched is None or int(p.rsplit("=", 1)[-1]) in touched]

    def _rows(self, state: dict, touched: set[int] | None = None) -> DataFrame:
        if TABLE not in state["tables"]:
            return self.spark.createDataFrame([], f"{cache.SCHEMA}, {BUCKET} int")
        return self.versions.read(TABLE, state, self._parts(state, touched))

    def _placed(self, rows: DataFrame, state: dict) -> DataFrame:
        return rows.withColumn(BUCKET, _bucket(F.col("key"), self._number(state)))

    def _touched(self, keys: DataFrame, state: dict) -> set[int]:
        """The buckets of some keys: no more rows than there are buckets."""
        return {r[0] for r in self._placed(keys.select("key").filter("key IS NOT NULL"), state).select(BUCKET).distinct().collect()}

    def _change(self, load_id: str, keys: DataFrame, as_of: str | Column, new: DataFrame | None) -> bool:
        while True:
            state = self.versions.latest()
            if load_id in state["loads"]:
                return False
            touched = self._touched(keys, state)
            gone = self._parts(state, touched)
            rows = cache.live(self._rows(state, touched).drop(BUCKET), as_of)
            rows = cache.delete(rows, keys) if new is None else cache.put(rows, new.select(*rows.columns))
            written, count = self.versions.write(load_id, TABLE, self._placed(rows, state), by=BUCKET)

            def publish(latest: dict) -> None:
                if self._parts(latest, touched) != gone or self._number(latest) != self._number(state):
                    raise _Moved
                replace(latest, TABLE, written, gone)
                latest["notes"][NUMBER] = self._number(state)
                latest["loads"][load_id] = {TABLE: count}

            try:
                return self.versions.commit(load_id, publish)
            except _Moved:
                continue

    def put(self, new: DataFrame, load_id: str, as_of: str | Column) -> bool:
        """Write entries with unique keys over those of the same keys; False if this load is committed already.

        Only the buckets of the new keys are read and written anew; entries in them that have expired by ``as_of`` go.
        """
        return self._change(load_id, new, as_of, new)

    def delete(self, keys: DataFrame, load_id: str, as_of: str | Column) -> bool:
        """Delete the entries of the given keys, as ``put`` writes."""
        return self._change(load_id, keys, as_of, None)

    def get(self, key: str, as_of: str | Column) -> DataFrame:
        """The live entry of a key, or no row; one bucket is read."""
        state = self.versions.latest()
        return cache.get(self._rows(state, {zlib.crc32(key.encode()) % self._number(state)}).drop(BUCKET), key, as_of)

    def get_many(self, keys: DataFrame, as_of: str | Column) -> DataFrame:
        """The live entries of the given keys; their buckets are read."""
        state = self.versions.latest()
        return cache.get_many(self._rows(state, self._touched(keys, state)).drop(BUCKET), keys, as_of)

    def live(self, as_of: str | Column) -> DataFrame:
        """All live entries."""
        return cache.live(self._rows(self.versions.latest()).drop(BUCKET), as_of)


def _bucket(key: Column, buckets: int) -> Column:
    return (F.crc32(key.cast("binary")) % buckets).cast("int")
