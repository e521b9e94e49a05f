"""Columns by exact name, whatever else a table holds, and tables kept in the shared folder."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from merchantry.llm.tokens import release
from merchantry.sources.store import scratch_path

# the words of all operators: runs of anything but ASCII white space
WORD = r"[^\x20\x09-\x0D]+"

# texts whose words a task holds at a time
TEXTS_AT_ONCE = 128


def shielded(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns renamed by position, and the new names of the columns ``names``.

    Columns that clash (also in nothing but upper and lower case) are then apart from each other and from
    the columns that an operator adds. Of two columns with the very same name the first is meant.
    """
    for name in names:
        if name not in df.columns:
            raise ValueError(f"no column {name!r} among {df.columns}")
    return df.toDF(*[f"in{i}" for i in range(len(df.columns))]), [f"in{df.columns.index(n)}" for n in names]


def restored(safe: DataFrame, df: DataFrame, *more: str) -> DataFrame:
    """The columns that ``df`` had under their own names, then the columns ``more`` of ``safe``."""
    return safe.select(*[f"in{i}" for i in range(len(df.columns))], *more).toDF(*df.columns, *more)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns ``names``."""
    safe, found = shielded(df, *names)
    return safe.select(*[F.col(c).alias(n) for c, n in zip(found, names)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back: computed once, its size known, safe from lost executors."""
    return stored_at(df, scratch_path(df.sparkSession, label))


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read from there. Columns are stored by position, so that any names will do."""
    safe = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    safe.write.parquet(path)
    return df.sparkSession.read.schema(safe.schema).parquet(path).toDF(*df.columns)


def add_from_text(df: DataFrame, text: str, schema: str, run: Callable[[list[str]], dict[str, list]]) -> DataFrame:
    """``df`` with the columns that ``run`` gives for batches of whole texts (null as empty), of types ``schema``."""
    safe, (body,) = shielded(df, text)
    at = safe.columns.index(body)
    more = StructType.fromDDL(schema)

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # caches hold hundreds of thousands of objects, none of them in cycles
        try:
            for whole in arrow:
                for k in range(0, whole.num_rows, TEXTS_AT_ONCE):
                    batch = whole.slice(k, TEXTS_AT_ONCE)
                    out = run(["" if t is None else t for t in batch.column(at).to_pylist()])
                    yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, out.values())], [*batch.schema.names, *out])
        finally:
            gc.enable()
            release()

    return restored(safe.mapInArrow(batches, StructType([*safe.schema.fields, *more.fields])), df, *more.names)


def per_text(df: DataFrame, id_column: str, text: str, schema: str,
             run: Callable[[list[str]], dict[str, list]]) -> DataFrame:
    """Only the id and the columns that ``run`` gives."""
    return add_from_text(pick(df, id_column, text), text, schema, run).drop(text)
