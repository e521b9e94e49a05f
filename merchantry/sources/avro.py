"""Avro: schemas of frames, and files through Spark's own format (the package spark-avro)."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Spark type and Avro type of the plain columns.
PLAIN = {
    T.BooleanType: "boolean", T.ByteType: "int", T.ShortType: "int", T.IntegerType: "int", T.LongType: "long",
    T.FloatType: "float", T.DoubleType: "double", T.StringType: "string", T.BinaryType: "bytes",
}
PLAIN_BACK = {
    "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(), "string": T.StringType(), "bytes": T.BinaryType(),
}


def create_schema(name: str, fields: list[dict]) -> dict:
    """A record schema from ``[{"name": ..., "type": ...}, ...]``."""
    return {"type": "record", "name": name, "fields": fields}


def avro_type(dtype: T.DataType, name: str):
    if type(dtype) in PLAIN:
        return PLAIN[type(dtype)]
    if isinstance(dtype, T.DateType):
        return {"type": "int", "logicalType": "date"}
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        local = "local-" if isinstance(dtype, T.TimestampNTZType) else ""
        return {"type": "long", "logicalType": f"{local}timestamp-micros"}
    if isinstance(dtype, T.DecimalType):
        return {"type": "bytes", "logicalType": "decimal", "precision": dtype.precision, "scale": dtype.scale}
    if isinstance(dtype, T.ArrayType):
        return {"type": "array", "items": _nullable(dtype.elementType, f"{name}_item", dtype.containsNull)}
    if isinstance(dtype, T.MapType):
        return {"type": "map", "values": _nullable(dtype.valueType, f"{name}_value", dtype.valueContainsNull)}
    if isinstance(dtype, T.StructType):
        return infer_schema(dtype, name)
    return "string"


def _nullable(dtype: T.DataType, name: str, nullable: bool):
    return ["null", avro_type(dtype, name)] if nullable else avro_type(dtype, name)


def infer_schema(schema: T.StructType, name: str = "Record") -> dict:
    """The Avro record schema of a Spark schema; 64-bit numbers stay 64-bit, nullable columns are unions."""
    return create_schema(name, [
        {"name": f.name, "type": _nullable(f.dataType, f"{name}_{f.name}", f.nullable)} for f in schema.fields
    ])


def spark_type(avro) -> tuple[T.DataType, bool]:
    """Spark type and nullability of an Avro type."""
    if isinstance(avro, list):
        rest = [a for a in avro if a != "null"]
        if len(rest) != 1:
            raise ValueError(f"only unions with null are supported: {avro}")
        return spark_type(rest[0])[0], "null" in avro
    if isinstance(avro, str):
        return PLAIN_BACK[avro], False
    logical, kind = avro.get("logicalType"), avro["type"]
    if logical == "date":
        return T.DateType(), False
    if logical in ("timestamp-micros", "local-timestamp-micros"):
        return (T.TimestampNTZType() if logical.startswith("local") else T.TimestampType()), False
    if logical == "decimal":
        return T.DecimalType(avro["precision"], avro.get("scale", 0)), False
    if kind == "array":
        element, nullable = spark_type(avro["items"])
        return T.ArrayType(element, nullable), False
    if kind == "map":
        value, nullable = spark_type(avro["values"])
        return T.MapType(T.StringType(), value, nullable), False
    if kind == "record":
        return spark_schema(avro), False
    return spark_type(kind)


def spark_schema(avro: dict) -> T.StructType:
    return T.StructType([T.StructField(f["name"], *spark_type(f["type"])) for f in avro["fields"]])


def _explained(error: AnalysisException) -> Exception:
    if "Failed to find data source: avro" in str(error):
        return RuntimeError("Avro files need Spark's avro package: start the session with --packages org.apache.spark:spark-avro_2.13")
    return error


def write_avro(df: DataFrame, path: str, schema: dict | None = None, codec: str = "deflate", mode: str = "overwrite") -> None:
    """Avro files by Spark's own format, with the inferred schema or the given one."""
    declared = json.dumps(schema or infer_schema(df.schema))
    try:
        df.write.format("avro").mode(mode).option("avroSchema", declared).option("compression", codec).save(path)
    except AnalysisException as error:
        raise _explained(error) from error


def read_avro(spark: SparkSession, path: str, schema: dict | None = None) -> DataFrame:
    """The records of Avro files; ``schema`` overrides the one in the files."""
    reader = spark.read.format("avro")
    try:
        return (reader.option("avroSchema", json.dumps(schema)) if schema else reader).load(path)
    except AnalysisException as error:
        raise _explained(error) from error
