"""Folders of tables that change by commits: files are written first, the rename of one small file makes them visible.

A folder holds ``data/<table>/load=<load>-<attempt>/...`` and ``_versions/<number>.json``. A version lists the file folders that
each table consists of, the loads that made it, and whatever else its writer has to remember. Readers follow the
newest version, so they see a load whole or not at all; what a broken attempt has written is in no version. Two writers
that publish at once: the rename of the second fails, and it starts again from the newer version.
"""

from __future__ import annotations

import copy
import json
import re
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchantry import schemas
from merchantry.sources.store import MONTH, remove

EMPTY = {"version": 0, "loads": {}, "tables": {}, "notes": {}}
LOAD = "load"


class Versions:
    """The versions of a folder, in any store with an atomic rename that never replaces a file."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._jvm = spark, folder.rstrip("/"), spark._jvm

    def _path(self, *names: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *names]))

    def _names(self, *names: str) -> list[str]:
        path = self._path(*names)
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def latest(self) -> dict:
        """The newest version; an empty one of number 0 for a new folder."""
        found = [n for n in self._names("_versions") if re.fullmatch(r"\d{12}\.json", n)]
        if not found:
            return copy.deepcopy(EMPTY)
        return json.loads(self.spark.read.text(f"{self.folder}/_versions/{found[-1]}", wholetext=True).first()[0])

    def _publish(self, state: dict) -> bool:
        """Write the version under a name of its own, then rename it; False if this number is taken."""
        hidden, name = self._path("_versions", f".{uuid.uuid4().hex}"), self._path("_versions", f"{state['version']:012d}.json")
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        out = hidden.getFileSystem(conf).create(hidden, False)
        out.write(json.dumps(state).encode())
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(hidden.toUri(), conf)
        never_replace = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(hidden, name, never_replace)
        except Py4JJavaError as error:
            remove(self.spark, hidden.toString())
            if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False
        return True

    def commit(self, load_id: str, change: Callable[[dict], None]) -> bool:
        """Publish the newest version as ``change`` alters it; False, and nothing done, if the load is part of it already."""
        while True:
            state = self.latest()
            if load_id in state["loads"]:
                return False
            state["version"] += 1
            change(state)
            state["loads"].setdefault(load_id, {})
            if self._publish(state):
                return True

    def write(self, load_id: str, name: str, df: DataFrame, by: str = MONTH) -> tuple[dict, int]:
        """Write rows that no version shows yet: what ``add`` and ``replace`` take, and their number.

        If there is a column ``by``, each of its values is a part of its own.
        """
        place = f"data/{name}/{LOAD}={re.sub('[^A-Za-z0-9_.-]', '_', load_id)}-{uuid.uuid4().hex[:8]}"
        seen = Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if by in df.columns:
            # large values are split over tasks, small ones share files
            rows.hint("rebalance", by).write.partitionBy(by).parquet(f"{self.folder}/{place}")
            parts = [f"{place}/{n}" for n in self._names(place) if n.startswith(f"{by}=")]
        else:
            rows.write.parquet(f"{self.folder}/{place}")
            parts = [place]
        plain = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
        return {"schema": json.loads(plain.json()), "parts": parts}, seen.get["rows"] if parts else 0

    def read(self, name: str, state: dict | None = None, parts: list[str] | None = None) -> DataFrame:
        """A table as of a version (the newest): all its parts, or some of them; months are partitions."""
        table = (state or self.latest())["tables"][name]
        schema = T.StructType.fromJson(table["schema"])
        parts = table["parts"] if parts is None else parts
        if not parts:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
        rows = self.spark.read.option("basePath", f"{self.folder}/data/{name}").schema(stored)
        return rows.parquet(*[f"{self.folder}/{p}" for p in parts]).select(*schema.names)

    def discard_unpublished(self) -> list[str]:
        """Delete what belongs to no table of the newest version (broken attempts, replaced parts); for when no writer is at work."""
        kept = {tuple(p.split("/")[:3]) for t in self.latest()["tables"].values() for p in t["parts"]}
        gone = [f"data/{name}/{load}" for name in self._names("data") for load in self._names("data", name) if ("data", name, load) not in kept]
        for path in gone:
            remove(self.spark, f"{self.folder}/{path}")
        return gone


def add(state: dict, name: str, written: dict) -> None:
    """The table with the written parts added; their columns must be the same."""
    table = state["tables"].setdefault(name, {"schema": written["schema"], "parts": []})
    if table["schema"] != written["schema"]:
        raise ValueError(f"columns of {name} differ from those it has")
    table["parts"] += written["parts"]


def replace(state: dict, name: str, written: dict, gone: list[str] | None = None) -> None:
    """The table with the written parts instead of all its parts, or of those named."""
    old = state["tables"].get(name, {"parts": []})["parts"]
    kept = [] if gone is None else [p for p in old if p not in set(gone)]
    state["tables"][name] = {"schema": written["schema"], "parts": kept + written["parts"]}


def month_of(part: str) -> str:
    """The last folder of a part: its month if the table has months."""
    return part.rsplit("/", 1)[-1]


def load(tables: dict[str, DataFrame], folder: str, load_id: str, order: list[str] | None = None) -> list[str]:
    """Append rows to all tables in one commit; the names in the order written, none if this load was committed before.

    Parents are written before children, and none is seen before all are. A load that broke, at whatever point, is simply
    run again: what it had written is in no version, and what it had committed is not repeated.
    """
    if not tables:
        return []
    versions = Versions(next(iter(tables.values())).sparkSession, folder)
    if load_id in versions.latest()["loads"]:
        return []
    order = [name for name in (order or schemas.LOAD_ORDER) if name in tables]
    written = {name: versions.write(load_id, name, tables[name]) for name in order}

    def change(state: dict) -> None:
        for name, (parts, _) in written.items():
            add(state, name, parts)
        state["loads"][load_id] = {name: rows for name, (_, rows) in written.items()}

    return order if versions.commit(load_id, change) else []


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The committed rows of a table."""
    return Versions(spark, folder).read(name)


def loads(spark: SparkSession, folder: str) -> DataFrame:
    """(load_id, place, table_name, row_count): the committed loads, their tables in the order written. A row per load and table."""
    rows = [(load_id, place, name, n) for load_id, tables in Versions(spark, folder).latest()["loads"].items() for place, (name, n) in enumerate(tables.items())]
    return spark.createDataFrame(rows, "load_id string, place int, table_name string, row_count long")
