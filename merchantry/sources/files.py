"""CSV, JSON and Parquet readers and file facts."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}

# What counts as a whole number and as a number in a text cell.
WHOLE = r"^\s*[+-]?\d+\s*$"
NUMBER = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def read_csv_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header row, every value as text.

    A file is split over tasks. Values with line breaks inside quotes need ``multi_line=True``, which reads a file as a whole.
    """
    return spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).csv(path)


def typed_columns(df: DataFrame) -> DataFrame:
    """Text columns as bigint if all their values are whole numbers, else double if all are numbers.

    Empty text is null. One aggregate over the data decides for all columns.
    """
    cleaned = df.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])
    tests = []
    for i, c in enumerate(cleaned.columns):
        v = F.col(f"`{c}`")
        whole = v.rlike(WHOLE) & v.try_cast("bigint").isNotNull()
        tests += [F.every(v.isNull() | whole).alias(f"w{i}"), F.every(v.isNull() | v.rlike(NUMBER)).alias(f"n{i}"),
                  F.count(v).alias(f"c{i}")]
    verdict = cleaned.agg(*tests).first()
    columns = []
    for i, c in enumerate(cleaned.columns):
        v = F.trim(F.col(f"`{c}`"))
        if verdict[f"c{i}"] and verdict[f"w{i}"]:
            columns.append(v.cast("bigint").alias(c))
        elif verdict[f"c{i}"] and verdict[f"n{i}"]:
            columns.append(v.cast("double").alias(c))
        else:
            columns.append(F.col(f"`{c}`").alias(c))
    return cleaned.select(*columns)


def typed_cells(df: DataFrame) -> DataFrame:
    """Text columns as VARIANT, typed cell by cell: a whole number (bigint, else decimal), else a double, else the text.

    Empty text is null. No pass over the data is needed, and one odd cell does not turn its column into text.
    """
    def cell(name: str) -> Column:
        v = F.nullif(F.col(name), F.lit(""))
        whole, number = v.rlike(WHOLE), v.rlike(NUMBER)
        kinds = [(whole, "bigint"), (whole, "decimal(38,0)"), (number, "double")]
        return F.coalesce(*[F.when(test, v.try_cast(kind)).cast("variant") for test, kind in kinds], v.cast("variant"))

    return df.select(*[cell(f"`{c}`").alias(c) for c in df.columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with a header row; types from ``schema`` or from the values. Empty cells are null."""
    if schema is None:
        return typed_columns(read_csv_text(spark, path, multi_line))
    return spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).schema(schema).csv(path)


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON files that each hold one array of records or one record."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON with one record, or one array of records, per line. A missing path is an error."""
    return spark.read.schema(schema).json(path)


CORRUPT = "_corrupt_record"


def _parsed_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """``(line, record, valid)`` of the lines that are not blank.

    Only lines that do not fit the schema are checked for being JSON at all: a value of an unexpected
    type is null, it does not cost the record.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = lines.filter(F.trim("value") != "").select(
        F.col("value").alias("line"), F.from_json("value", wide, {"columnNameOfCorruptRecord": CORRUPT}).alias("record")
    )
    fits = F.col("record").isNotNull() & F.col(f"record.{CORRUPT}").isNull()
    return parsed.withColumn("valid", F.when(fits, F.lit(True)).otherwise(F.try_parse_json("line").isNotNull()))


def parse_json_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The records of text lines (batch or stream); blank lines and lines that are not JSON are skipped."""
    return _parsed_lines(lines, schema).filter("valid").select(*[F.col(f"record.`{n}`").alias(n) for n in schema.names])


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines; blank and malformed lines are skipped."""
    if schema is None:
        schema = spark.read.option("mode", "DROPMALFORMED").json(path).schema
    return parse_json_lines(spark.read.text(path), schema)


def malformed_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The lines that ``read_json_lines`` skips, but for blank ones."""
    return _parsed_lines(spark.read.text(path), schema).filter("NOT valid").select("line")


def read_table_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """The table at ``path``, or no rows where there is no such path."""
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


COMPARISONS = {
    "=": lambda c, v: c == v, "==": lambda c, v: c == v, "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v, "<=": lambda c, v: c <= v, ">": lambda c, v: c > v, ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)), "not in": lambda c, v: ~c.isin(list(v)),
}


def conjunction(filters: Iterable[tuple]) -> Column:
    """``[(column, operator, value), ...]`` joined by AND."""
    out = F.lit(True)
    for name, op, value in filters:
        if op not in COMPARISONS:
            raise ValueError(f"unknown comparison: {op}")
        out = out & COMPARISONS[op](F.col(name), value)
    return out


def read_parquet_where(spark: SparkSession, path: str, filters: Iterable[tuple]) -> DataFrame:
    """Parquet rows that meet all the comparisons; the scan gets them as pushed filters."""
    return spark.read.parquet(path).filter(conjunction(filters))


def file_sizes(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``(path, length)`` per file; the contents are not read. No such path gives no rows."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        return reader.load(path).select("path", "length")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length bigint")


def size_mb(spark: SparkSession, path: str) -> DataFrame:
    """Total size in MiB, 0 for a missing path."""
    return file_sizes(spark, path).agg((F.coalesce(F.sum("length"), F.lit(0)) / 1048576).alias("size_mb"))


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and of columns; no rows means no columns, as for a list of records."""
    width = F.lit(len(df.columns)).cast("bigint")
    return df.agg(F.count("*").alias("row_count")).select("row_count", F.when(F.col("row_count") > 0, width).otherwise(F.lit(0).cast("bigint")).alias("column_count"))


FOOTER_SCHEMA = """file_path STRING, num_rows BIGINT, num_columns BIGINT, num_row_groups BIGINT, serialized_size BIGINT,
    schema STRING"""


def file_system(uri: str):
    """File system and path of a URI, for the few places where a task opens a file itself."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    if not colon:
        return fs.FileSystem.from_uri(f"file://{os.path.abspath(uri)}")
    if scheme == "file":
        return fs.FileSystem.from_uri("file:///" + rest.lstrip("/"))
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def _footers(batches: Iterator) -> Iterator:
    import pandas as pd
    import pyarrow.parquet as pq

    for batch in batches:
        rows = []
        for uri in batch["path"]:
            system, path = file_system(uri)
            with system.open_input_file(path) as f:
                file = pq.ParquetFile(f)
                m = file.metadata
                rows.append((uri, m.num_rows, m.num_columns, m.num_row_groups, m.serialized_size, str(file.schema)))
        yield pd.DataFrame(rows, columns=["file_path", "num_rows", "num_columns", "num_row_groups", "serialized_size", "schema"])


def parquet_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Footer facts per Parquet file; the executors open the footers, the data pages are not read."""
    files = file_sizes(spark, path, "*.parquet").select("path")
    return files.repartition(spark.sparkContext.defaultParallelism).mapInPandas(_footers, FOOTER_SCHEMA)


def unnest_pages(spark: SparkSession, path: str, entity: str, schema: T.StructType) -> DataFrame:
    """Records of landed pages ``{entity: [record, ...]}``; pages without the entity count as empty."""
    page = T.StructType([T.StructField(entity, T.ArrayType(schema))])
    return spark.read.schema(page).json(path).select(F.explode(entity).alias("r")).select("r.*")


def unnest_pages_in_order(spark: SparkSession, path: str, entity: str, schema: T.StructType, limit: int) -> DataFrame:
    """Records of landed pages ``{entity: [record, ...], skip: n}`` as one sees them who asks for page after page.

    Pages count from ``skip`` 0 in steps of ``limit`` up to the first one with fewer than ``limit`` records, which still counts;
    what lies behind it does not. A missing page and one without the entity are short ones. Pages off the steps or without ``skip``
    are left out, and a page that landed twice is read twice. Only the numbers of the full pages are shuffled.
    """
    page = T.StructType([T.StructField(entity, T.ArrayType(schema)), T.StructField("skip", T.LongType())])
    pages = spark.read.schema(page).json(path).filter(F.col("skip") >= 0).filter(F.col("skip") % limit == 0)
    full = pages.filter(F.size(entity) >= limit).select("skip")
    # a page is asked for if it is the first or follows a full one; the first of them that is not full is the last one read
    asked = full.select((F.col("skip") + limit).alias("skip")).union(spark.range(1).select(F.lit(0).cast("bigint").alias("skip")))
    last = asked.join(full, "skip", "left_anti").agg(F.min("skip"))
    return pages.filter(F.col("skip") <= last.scalar()).select(F.explode(entity).alias("r")).select("r.*")
