"""Shared scratch space: settled intermediates and models that are built once and read many times."""

from __future__ import annotations

import hashlib
import tempfile
import threading
import uuid
from collections.abc import Callable, ItemsView, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

ACTIONS_AT_ONCE = 4
# a stored table that has this column is partitioned by it
MONTH = "month_id"

Keep = Callable[[str, DataFrame], DataFrame]

_models: dict[tuple[str, str, str], tuple[str, str, Stored]] = {}
_locks: dict[tuple[str, str, str], threading.RLock] = {}
_guard = threading.Lock()
_own_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for a local session without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    with _guard:
        own = spark.sparkContext.applicationId
        if own not in _own_folders:
            _own_folders[own] = tempfile.mkdtemp(prefix="merchantry-")
        return _own_folders[own]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/merchantry/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete what was written under ``path``, in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def settle(df: DataFrame) -> DataFrame:
    """Write the rows out and read them back, so that later reads see exactly the same rows."""
    path = scratch_path(df.sparkSession, "settled")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_once(actions: list[Callable[[], object]]) -> None:
    """Run independent Spark actions side by side, so that the tail of one does not leave executors idle."""
    with ThreadPoolExecutor(ACTIONS_AT_ONCE) as pool:
        for done in [pool.submit(action) for action in actions]:
            done.result()


def as_is(name: str, df: DataFrame) -> DataFrame:
    """The ``keep`` of a builder that stays lazy."""
    return df


def kept_at_once(keep: Keep, tables: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Build and keep independent tables; one after the other if ``keep`` is lazy."""
    kept: dict[str, DataFrame] = {}
    steps = [lambda n=name, make=build: kept.update({n: keep(n, make())}) for name, build in tables.items()]
    if keep is as_is:
        for step in steps:
            step()
    else:
        at_once(steps)
    return kept


class Stored(Mapping):
    """The tables of a model. One that is given as a function of the model is built and written when it is first asked for."""

    def __init__(self, tables: dict[str, DataFrame | Callable[[Mapping], DataFrame]], keep: Callable[[str, DataFrame], DataFrame]):
        self._tables, self._keep = dict(tables), keep
        # tables are built from others without cycles, so threads that build several never wait for each other
        self._locks = {name: threading.RLock() for name in tables}

    def __getitem__(self, name: str) -> DataFrame:
        with self._locks[name]:
            if not isinstance(self._tables[name], DataFrame):
                self._tables[name] = self._keep(name, self._tables[name](self))
            return self._tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def __contains__(self, name: object) -> bool:
        return name in self._tables

    def built(self, name: str) -> bool:
        """Whether the table is there already."""
        return isinstance(self._tables[name], DataFrame)

    def items(self) -> ItemsView:
        """All tables, those that are not there yet built side by side."""
        at_once([lambda n=name: self[n] for name in self._tables])
        return dict(self._tables).items()


def once(build: Callable[[], dict[str, DataFrame]]) -> Callable[[], dict[str, DataFrame]]:
    """``build`` as a function that runs it once, for tables that are built together."""
    lock, built = threading.Lock(), []

    def get() -> dict[str, DataFrame]:
        with lock:
            if not built:
                built.append(build())
            return built[0]

    return get


def _state(spark: SparkSession, source: str) -> str:
    """A digest of the names, lengths and times of the files under ``source``; no contents are read."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
        rows = files.selectExpr("xxhash64(path, length, modificationTime) AS h").selectExpr("count(*)", "bit_xor(h)").first()
        return repr(tuple(rows))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return ""


def stored(
    spark: SparkSession, source: str, model: str, build: Callable[[Keep], dict[str, DataFrame | Callable[[Mapping], DataFrame]]]
) -> Stored:
    """The tables of a model, written on first use in this session and read from there afterwards.

    ``build`` gets a ``keep(name, df)`` that writes a table at once and returns what was written, for
    tables that later ones are built from. A table that it returns as a function of the model is built when it is first asked
    for, so a query builds what it reads; files that have changed by then are an error. If files under ``source`` change, the model is built anew. Two threads that
    ask for one model wait for one build. ``release`` deletes what was written.
    """
    key = (spark.sparkContext.applicationId, source, model)
    with _guard:
        lock = _locks.setdefault(key, threading.RLock())
    with lock:
        state = _state(spark, source)
        if key in _models and _models[key][1] == state:
            return _models[key][2]
        release(spark, source, model)
        tag = hashlib.sha1(source.encode()).hexdigest()[:8]
        root = scratch_path(spark, f"{model}-{tag}")
        kept: dict[str, DataFrame] = {}

        def keep(name: str, df: DataFrame) -> DataFrame:
            path = f"{root}/{name}"
            if MONTH in df.columns:
                rows = df if getattr(df, "_dealt", False) else by_month(df)
                rows.write.option("compression", "zstd").partitionBy(MONTH).parquet(path)
            else:
                df.write.option("compression", "zstd").parquet(path)
            kept[name] = spark.read.schema(df.schema).parquet(path)
            return kept[name]

        def keep_once(name: str, df: DataFrame) -> DataFrame:
            return kept[name] if name in kept else df if getattr(df, "_lasting", False) else keep(name, df)

        def unchanged(name: str, df: DataFrame) -> DataFrame:
            out = keep_once(name, df)
            if _state(spark, source) != state:
                raise RuntimeError(f"files under {source} have changed; ask for the model {model} again")
            return out

        tables = build(keep)
        there = {name: df for name, df in tables.items() if isinstance(df, DataFrame)}
        at_once([lambda n=name, d=df: keep_once(n, d) for name, df in there.items()])
        _models[key] = (root, state, Stored({**tables, **{name: kept.get(name, df) for name, df in there.items()}}, unchanged))
        return _models[key][2]


def lasting(df: DataFrame) -> DataFrame:
    """Mark a frame that reads settled rows, so that a model takes it as it is instead of writing it again."""
    df._lasting = True
    return df


def unbroadcast(df: DataFrame) -> DataFrame:
    """Join these rows by a shuffle. Spark takes a few columns of a wide or well compressed table for as small as their share of
    the files, and would send millions of rows through the driver.
    """
    return df.hint("merge")


def by_month(df: DataFrame) -> DataFrame:
    """Deal rows to tasks by month: large months are split over tasks, small ones share files."""
    return df.hint("rebalance", MONTH)


def dealt(df: DataFrame) -> DataFrame:
    """Mark a frame whose rows ``by_month`` has dealt before columns were added, so that a model writes them where they are."""
    df._dealt = True
    return df


def release(spark: SparkSession, source: str, model: str | None = None) -> None:
    """Forget the stored models of ``source`` (or one of them) and delete their files."""
    for key in [k for k in _models if k[:2] == (spark.sparkContext.applicationId, source) and model in (None, k[2])]:
        remove(spark, _models.pop(key)[0])
