"""Data in chunks: of n rows in a given order, or of files by a stream that stops at the end of the data."""

from __future__ import annotations

from collections.abc import Callable
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchantry.functions.numbering import id_by_order
from merchantry.sources.files import CSV_OPTIONS, parse_json_lines
from merchantry.sources.store import scratch_path

if TYPE_CHECKING:
    import pandas as pd

ROWS = 1000
# every micro-batch costs seconds however few rows it has
FILES = 32


def row_chunks(df: DataFrame, order: list[str], rows: int = ROWS, name: str = "chunk") -> DataFrame:
    """``df`` with the number, from 0, of the chunk of ``rows`` rows that each row is in; the last one may be shorter.

    Rows are numbered in the order of the columns ``order``, so chunks are the same in every run. They are written out in that
    order: reading one chunk skips the files and row groups of the others.
    """
    numbered = id_by_order(df, order, "_row", first=0)
    return numbered.withColumn(name, F.call_function("div", "_row", F.lit(rows))).drop("_row")


class _Place:
    """How many chunks are done, as the name of an empty file in a folder of any store."""

    def __init__(self, spark: SparkSession, folder: str):
        self._path = lambda *names: spark._jvm.org.apache.hadoop.fs.Path("/".join([folder, *names]))
        self._files = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def done(self) -> int:
        if not self._files.exists(self._path()):
            return 0
        return max((int(status.getPath().getName()) for status in self._files.listStatus(self._path())), default=0)

    def reach(self, number: int) -> None:
        self._files.create(self._path(str(number)), True).close()
        self._files.delete(self._path(str(number - 1)), False)


def _kept_chunks(df: DataFrame, order: list[str], rows: int, folder: str) -> DataFrame:
    """The numbered rows as an earlier run has written them to ``folder``, else written now."""
    spark = df.sparkSession
    whole = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if not whole.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(whole):
        row_chunks(df, order, rows, "_chunk").write.mode("overwrite").parquet(folder)
    return spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_chunk", T.LongType())])).parquet(folder)


def for_each_rows(
    df: DataFrame, order: list[str], handle: Callable[[DataFrame, int], None], rows: int = ROWS, checkpoint: str | None = None,
) -> int:
    """Call ``handle(rows, number)`` chunk by chunk, in order; returns the number of chunks. A chunk is a job: for consumers that
    need one after the other. ``map_rows`` works on all chunks at once.

    With a folder ``checkpoint`` the rows, cut into chunks, and the number of finished ones are kept there. A run with the same
    folder goes on after the last finished chunk, with the same rows and chunk size, whatever ``df`` holds by then; ``handle`` may
    see a chunk twice after a failure.
    """
    chunked = _kept_chunks(df, order, rows, f"{checkpoint}/rows") if checkpoint else row_chunks(df, order, rows, "_chunk")
    place = _Place(df.sparkSession, f"{checkpoint}/done") if checkpoint else None
    last = chunked.agg(F.max("_chunk")).first()[0]
    count = 0 if last is None else last + 1
    for number in range(place.done() if place else 0, count):
        handle(chunked.filter(F.col("_chunk") == number).drop("_chunk"), number)
        if place:
            place.reach(number + 1)
    return count


def map_rows(
    df: DataFrame, order: list[str], work: Callable[[pd.DataFrame, int], pd.DataFrame], schema: str | T.StructType, rows: int = ROWS,
) -> DataFrame:
    """The rows that ``work(rows, number)`` makes of each chunk, all chunks in one job.

    ``work`` runs in the executors on a pandas frame of at most ``rows`` rows in the order of the columns ``order``, indexed from
    0. A task holds one chunk at a time, so its memory depends on ``rows`` only; the chunks of a lost task are worked on again.
    No rows, no chunk.
    """
    def chunk(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return work(frame.sort_values("_row").drop(columns="_row").reset_index(drop=True), int(key[0]))

    numbered = id_by_order(df, order, "_row", first=0)
    return numbered.groupBy(F.call_function("div", "_row", F.lit(rows)).alias("_chunk")).applyInPandas(chunk, schema)


def rows_per_file(rows: int, least: int, files: int = FILES) -> int:
    """How many of ``rows`` rows to write to a file, ``least`` or more, so that a stream over them, file by file, takes about
    ``files`` micro-batches however many rows there are. (Each writing task may leave one more, shorter file.)
    """
    return max(least, -(-rows // files))


OPTIONS = {"csv": {**CSV_OPTIONS, "multiLine": "true"}}


def chunk_stream(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType, files_per_chunk: int = 1,
    max_bytes: str | None = None, **options: str,
) -> DataFrame:
    """A streaming frame over the files at ``path``; a chunk is some files or about ``max_bytes`` of them.

    JSON is read by lines, skipping blank and malformed ones.
    """
    reader = spark.readStream.options(**{**OPTIONS.get(fmt, {}), **options})
    reader = reader.option("maxBytesPerTrigger", max_bytes) if max_bytes else reader.option("maxFilesPerTrigger", files_per_chunk)
    if fmt == "json":
        return parse_json_lines(reader.text(path), schema)
    return reader.format(fmt).schema(schema).load(path)


def for_each_chunk(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str | None = None) -> None:
    """Call ``handle(rows, number)`` per chunk until all files are read.

    Reusing a ``checkpoint`` goes on after the last finished chunk; ``handle`` may see a chunk twice after a failure.
    """
    folder = checkpoint or scratch_path(stream.sparkSession, "chunks")
    query = (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", folder).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def copy_in_chunks(stream: DataFrame, target: str, checkpoint: str | None = None) -> DataFrame:
    """Write each chunk to its own folder under ``target``, so a repeated chunk replaces itself; read all back."""
    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{target}/chunk={number}")

    for_each_chunk(stream, write, checkpoint)
    return stream.sparkSession.read.schema(T.StructType([*stream.schema.fields, T.StructField("chunk", T.LongType())])).parquet(target)


def chunk_sizes(copied: DataFrame) -> DataFrame:
    return copied.groupBy("chunk").agg(F.count("*").alias("row_count"))
