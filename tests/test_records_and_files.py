"""Hand-computed results on the small product fixture, and file readers and writers."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchantry.operators import records
from merchantry.sources import avro, files, sinks

PRODUCTS = [
    (1, "Product A", 100.50, 50, True, "Electronics"), (2, "Product B", 200.75, 30, True, "Electronics"),
    (3, "Product C", 50.25, 100, False, "Home"), (4, "Product D", 150.00, 20, True, "Electronics"),
    (5, "Product E", 75.50, 60, True, "Home"),
]


@pytest.fixture
def products(spark):
    return spark.createDataFrame(PRODUCTS, "id bigint, name string, price double, stock int, active boolean, category string")


@pytest.fixture
def four(products):
    return products.filter("id <= 4")


@pytest.mark.parametrize("op, value", [("sum", 501.5), ("count", 4), ("min", 50.25), ("max", 200.75), ("avg", 125.375)])
def test_aggregate(four, op, value):
    assert records.aggregate(four, "price", op).first()[0] == value


@pytest.mark.parametrize("op", list(records.AGGREGATES))
def test_aggregate_of_nothing_is_zero(spark, op):
    nulls = spark.createDataFrame([(None,), (None,)], "x double")
    assert records.aggregate(nulls, "x", op).first()[0] == 0
    assert records.aggregate(nulls.limit(0), "x", op).first()[0] == 0


def test_aggregate_rejects_unknown_operation(four):
    with pytest.raises(ValueError, match="median"):
        records.aggregate(four, "price", "median")


def test_filters(four):
    assert [r.id for r in records.filter_rows(four, "price > 100").orderBy("id").collect()] == [1, 2, 4]
    assert [r.id for r in records.filter_by_function(four, lambda r: r["price"] > 100).orderBy("id").collect()] == [1, 2, 4]


def test_sort_counts_missing_as_zero_and_keeps_ties_in_order(spark, four):
    assert [r.name[-1] for r in records.sort_rows(four, "price", reverse=True).collect()] == ["B", "D", "A", "C"]
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1), (4, 0), (5, 5)], "pos int, x int")
    assert [r.pos for r in records.sort_rows(df, "x", position="pos").collect()] == [3, 2, 4, 1, 5]
    assert [r.pos for r in records.sort_rows(df, "x", True, "pos").collect()] == [1, 5, 2, 4, 3]


def test_lookup(four):
    assert records.by_ids(four, [2]).first().name == "Product B"
    assert records.by_ids(four, four.filter("stock > 40").select("id")).count() == 2


def test_csv_cells(spark, tmp_path):
    path = tmp_path / "cells.csv"
    path.write_text('whole,number,mixed,empty,text,padded\n007,1.5,1,,"a ""b"", c", 5 \n-3,nan,x,,1_000,6\n,1e3,2,,,7\n')
    df = files.read_csv(spark, str(path))
    assert [t for _, t in df.dtypes] == ["bigint", "double", "string", "string", "string", "bigint"]
    got = [tuple(r) for r in df.collect()]
    assert [r[0] for r in got] == [7, -3, None]
    assert got[0][1] == 1.5 and got[1][1] != got[1][1] and got[2][1] == 1000.0
    assert [r[2] for r in got] == ["1", "x", "2"] and [r[3] for r in got] == [None] * 3
    assert [r[4] for r in got] == ['a "b", c', "1_000", None] and [r[5] for r in got] == [5, 6, 7]
    assert all(t == "string" for _, t in files.read_csv_text(spark, str(path)).dtypes)


def test_csv_numbers_beyond_64_bits_are_doubles(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("n\n99999999999999999999\n1\n")
    assert files.read_csv(spark, str(path)).dtypes == [("n", "double")]


def test_csv_round_trip_keeps_quotes_and_line_breaks(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 'say "hi", twice'), (2, "two\nlines"), (3, None)], "id bigint, text string")
    assert sinks.write_csv(df, str(tmp_path / "out"))
    assert rows(files.read_csv(spark, str(tmp_path / "out"), multi_line=True)) == rows(df)


def test_json_documents(spark, tmp_path):
    (tmp_path / "many.json").write_text(json.dumps([{"id": 1, "tags": ["a"]}, {"id": 2, "tags": []}], indent=2))
    (tmp_path / "one.json").write_text(json.dumps({"id": 3, "tags": None}, indent=2))
    assert files.read_json_documents(spark, str(tmp_path / "many.json")).count() == 2
    assert [r.id for r in files.read_json_documents(spark, str(tmp_path / "one.json")).collect()] == [3]


def test_json_lines_skip_blank_and_broken(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"id": 1}\n\n{"id": 2\n   \n{"id": 3}\nnot json\n')
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert sorted(r.id for r in files.read_json_lines(spark, str(path), schema).collect()) == [1, 3]
    assert sorted(r.line for r in files.malformed_json_lines(spark, str(path), schema).collect()) == ['not json', '{"id": 2']


def test_json_lines_keep_records_with_unexpected_values(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"id": "seven", "n": 1}\n{"id": 8}\n{"id": 9, "n": [1]}\n[oops\n{}\n')
    schema = T.StructType.fromDDL("id bigint, n int")
    df = files.read_json_lines(spark, str(path), schema)
    assert sorted(map(tuple, df.collect()), key=repr) == sorted([(None, 1), (8, None), (9, None), (None, None)], key=repr)
    assert df.count() == df.select("id").count() == 4
    assert [r.line for r in files.malformed_json_lines(spark, str(path), schema).collect()] == ["[oops"]
    assert files.read_json_lines(spark, str(path)).count() == 4


def test_missing_paths(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert files.read_table_or_empty(spark, str(tmp_path / "no"), schema).collect() == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.schema(schema).json(str(tmp_path / "no"))
    assert files.size_mb(spark, str(tmp_path / "no")).first()[0] == 0


def test_empty_frames_are_not_written(spark, tmp_path, products):
    nothing = products.limit(0)
    for write in (sinks.write_csv, sinks.write_json_lines, sinks.write_parquet):
        assert not write(nothing, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


@pytest.mark.parametrize("codec", [*sinks.PARQUET_CODECS, None])
def test_parquet_codecs(spark, tmp_path, products, rows, codec):
    sinks.write_parquet(products, str(tmp_path / "p"), codec)
    assert rows(files.read_parquet(spark, str(tmp_path / "p"))) == rows(products)


def test_parquet_unknown_codec(tmp_path, products):
    with pytest.raises(ValueError, match="brotli"):
        sinks.write_parquet(products, str(tmp_path / "p"), "brotli")


def test_parquet_pushdown(spark, tmp_path, products):
    sinks.write_parquet(products, str(tmp_path / "p"))
    hits = files.read_parquet_where(spark, str(tmp_path / "p"), [("price", ">", 100), ("stock", ">", 20)])
    assert sorted(r.name for r in hits.collect()) == ["Product A", "Product B"]
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(price,100.0)" in plan and "GreaterThan(stock,20)" in plan
    with pytest.raises(ValueError):
        files.conjunction([("price", "~", 1)])


def test_parquet_metadata_and_size(spark, tmp_path, products):
    products.coalesce(1).write.parquet(str(tmp_path / "p"))
    facts = files.parquet_metadata(spark, str(tmp_path / "p")).first()
    assert (facts.num_rows, facts.num_columns, facts.num_row_groups) == (5, 6, 1) and "price" in facts.schema
    size = sum(f.stat().st_size for f in (tmp_path / "p").glob("*.parquet"))
    assert files.file_sizes(spark, str(tmp_path / "p"), "*.parquet").agg(F.sum("length")).first()[0] == size
    assert tuple(files.shape(products).first()) == (5, 6) and tuple(files.shape(products.limit(0)).first()) == (0, 0)


def test_pages(spark, tmp_path):
    (tmp_path / "p1.json").write_text(json.dumps({"users": [{"id": 1}, {"id": 2}], "total": 3}))
    (tmp_path / "p2.json").write_text(json.dumps({"users": [{"id": 3}]}) + "\n" + json.dumps({"other": []}))
    got = files.unnest_pages(spark, str(tmp_path), "users", T.StructType([T.StructField("id", T.LongType())]))
    assert sorted(r.id for r in got.collect()) == [1, 2, 3]


def test_avro_files_need_the_package(spark, tmp_path):
    """With Spark's package a round trip, without it an error that says what is missing."""
    path, df = str(tmp_path / "a"), spark.createDataFrame([(1, 2.5), (2, None)], "id int, price double")
    try:
        avro.write_avro(df, path)
    except RuntimeError as error:
        assert "spark-avro" in str(error)
        with pytest.raises(RuntimeError, match="spark-avro"):
            avro.read_avro(spark, path)
    else:
        assert sorted(map(tuple, avro.read_avro(spark, path).collect())) == [(1, 2.5), (2, None)]


AVRO_TYPES = """b boolean, i int, l bigint, f float, d double, s string, y binary, day date, at timestamp_ntz, m decimal(10,2),
    tags array<string>, props map<string,string>, inner struct<a:int, b:array<bigint>>"""


def test_avro_types_there_and_back():
    schema = T.StructType.fromDDL(AVRO_TYPES)
    assert avro.spark_schema(avro.infer_schema(schema)).simpleString() == schema.simpleString()
    given = avro.create_schema("Product", [{"name": "id", "type": "int"}, {"name": "price", "type": ["null", "double"]}])
    assert avro.spark_schema(given).simpleString() == "struct<id:int,price:double>"


def test_avro_schema_of_a_frame():
    schema = T.StructType.fromDDL("flag boolean not null, n int not null, big bigint, x double, tags array<string>, m map<string,string>")
    fields = {f["name"]: f["type"] for f in avro.infer_schema(schema, "R")["fields"]}
    assert fields["flag"] == "boolean" and fields["n"] == "int" and fields["big"] == ["null", "long"]
    assert fields["tags"][1]["type"] == "array" and fields["m"][1]["type"] == "map"
    assert avro.spark_schema(avro.infer_schema(schema)).simpleString() == schema.simpleString()


def test_insert_ignore(spark, rows):
    existing = spark.createDataFrame([("a", "old", 1)], "k string, v string, pos bigint")
    new = spark.createDataFrame([("a", "new", 2), ("b", "second", 4), ("b", "first", 3), ("c", "only", 5)], existing.schema)
    assert rows(sinks.insert_ignore(existing, new, ["k"], "pos"), "k", "v") == [("b", "first"), ("c", "only")]
    assert rows(sinks.upsert_ignore(existing, new, ["k"], "pos"), "k", "v") == [("a", "old"), ("b", "first"), ("c", "only")]


def test_generated_ids_go_on(spark, rows):
    existing = spark.createDataFrame([(7,), (3,)], "id bigint")
    new = spark.createDataFrame([("x", 20), ("y", 10)], "name string, pos bigint")
    assert rows(sinks.with_generated_ids(new, existing, "id", "pos"), "name", "id") == [("x", 9), ("y", 8)]
    assert rows(sinks.with_generated_ids(new, existing.limit(0), "id", "pos"), "name", "id") == [("x", 2), ("y", 1)]


def test_append_goes_parents_first(spark, tmp_path):
    one = spark.range(1)
    order = sinks.append_tables({"order_items": one, "users": one, "orders": one}, str(tmp_path))
    assert order == ["users", "orders", "order_items"]


def test_export(spark, tmp_path):
    df = spark.sql("""SELECT CAST(1.50 AS DECIMAL(10,2)) AS m, DATE '2024-02-03' AS d, TIMESTAMP_NTZ '2024-02-03 04:05:06' AS t,
        TIMESTAMP_NTZ '2024-02-03 04:05:06.7' AS u""")
    assert tuple(sinks.export_ready(df).first()) == (1.5, "2024-02-03", "2024-02-03T04:05:06", "2024-02-03T04:05:06.700000")
    paths = sinks.export_fact(df, str(tmp_path))
    assert spark.read.json(paths["json"]).count() == spark.read.parquet(paths["parquet"]).count() == 1
    assert sinks.export_fact(df.limit(0), str(tmp_path / "none")) == {}


def test_writers_run_their_input_once_and_leave_nothing_empty(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        runs.add(1)
        yield from batches

    df = spark.range(4).coalesce(1).mapInArrow(counted, "id long")
    for write in (sinks.write_csv, sinks.write_json_lines, sinks.write_parquet):
        before, path = runs.value, str(tmp_path / write.__name__)
        assert write(df, path) is True and runs.value == before + 1
        assert write(df.limit(0), path, mode="append") is False and (tmp_path / write.__name__).exists()
        assert write(df.limit(0), str(tmp_path / "none")) is False and not (tmp_path / "none").exists()


def test_chunks_of_rows(spark):
    from merchantry.streaming import chunks

    data = [(i * 7919 % 1009, f"v{i}") for i in range(1000)]
    df = spark.createDataFrame(data, "k long, v string").repartition(5)
    seen = []
    n = chunks.for_each_rows(df, ["k", "v"], lambda rows, number: seen.append((number, sorted(tuple(r) for r in rows.collect()))), 300)
    ordered = sorted(data)
    assert n == 4 and seen == [(c, ordered[c * 300 : c * 300 + 300]) for c in range(4)]
    assert chunks.for_each_rows(df.limit(0), ["k"], lambda rows, number: seen.append(number)) == 0


def test_chunks_go_on_after_a_failure(spark, tmp_path):
    from merchantry.streaming import chunks

    df, seen, folder = spark.range(1000).repartition(5), [], str(tmp_path / "checkpoint")

    def handle(rows, number):
        found = sorted(r.id for r in rows.collect())
        if number == 2 and not broken:
            broken.append(number)
            raise RuntimeError("stopped")
        seen.append((number, found[0], found[-1]))

    broken = []
    with pytest.raises(RuntimeError, match="stopped"):
        chunks.for_each_rows(df, ["id"], handle, 300, folder)
    assert [n for n, *_ in seen] == [0, 1]
    # the rows are those of the first run, and so is the size of a chunk
    assert chunks.for_each_rows(df.filter("id > 500"), ["id"], handle, 100, folder) == 4
    assert seen == [(0, 0, 299), (1, 300, 599), (2, 600, 899), (3, 900, 999)]
    assert chunks.for_each_rows(df, ["id"], handle, 300, folder) == 4 and len(seen) == 4


def test_work_on_chunks_in_one_job(spark):
    from merchantry.streaming import chunks

    data = [(i % 7, None if i % 11 == 0 else f"v{i}") for i in range(1000)] + [(None, "x")] * 5 + [(3, "same")] * 400
    df = spark.createDataFrame(data, "k long, v string").repartition(5)

    def ends(rows, number):
        assert list(rows.index) == list(range(len(rows)))
        return rows.head(1).assign(number=number, size=len(rows))[["number", "size", "k"]]

    got = sorted(tuple(r) for r in chunks.map_rows(df, ["k", "v"], ends, "number long, size long, k long", 300).collect())
    ordered = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [g[:2] for g in got] == [(0, 300), (1, 300), (2, 300), (3, 300), (4, 205)]
    assert [g[2] for g in got] == [ordered[n * 300][0] for n in range(5)]
    assert chunks.map_rows(df.limit(0), ["k"], ends, "number long, size long, k long").count() == 0


def test_pages_end_at_the_first_short_one(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType())])

    def read(pages):
        path = tmp_path / f"pages-{len(list(tmp_path.iterdir()))}"
        path.mkdir()
        for n, page in enumerate(pages):
            (path / f"{n}.json").write_text(json.dumps(page))
        return sorted(r.id for r in files.unnest_pages_in_order(spark, str(path), "users", schema, 2).collect())

    def page(skip, *ids):
        return {"users": [{"id": i} for i in ids], "skip": skip}

    assert read([page(2, 3, 4), page(0, 1, 2), page(4, 5), page(6, 7, 8)]) == [1, 2, 3, 4, 5]
    assert read([page(0, 1, 2), page(2, 3, 4), page(6, 7, 8)]) == [1, 2, 3, 4]  # a missing page
    assert read([page(0, 1, 2), {"skip": 2}, page(4, 5, 6)]) == [1, 2]
    assert read([page(2, 3, 4)]) == [] and read([page(0, 1)]) == [1] and read([page(0, 1, 2)]) == [1, 2]
    assert read([page(0, 1, 2), page(1, 9, 9), page(2), {"users": [{"id": 8}]}]) == [1, 2]


def test_cells_have_their_own_types(spark):
    df = spark.createDataFrame([("1",), ("2.5",), ("x",), ("",), (None,), (" 7 ",), ("99999999999999999999",), ("1e3",), ("1_0",)], "a string")
    kinds = files.typed_cells(df).selectExpr("schema_of_variant(a) AS k", "CAST(a AS string) AS v").collect()
    assert [r.k for r in kinds] == ["BIGINT", "DOUBLE", "STRING", None, None, "BIGINT", "DECIMAL(20,0)", "DOUBLE", "STRING"]
    assert [r.v for r in kinds] == ["1", "2.5", "x", None, None, "7", "99999999999999999999", "1000.0", "1_0"]


def test_collections_are_compressed_json_lines(spark, tmp_path):
    people = spark.range(500).selectExpr("id AS _id", "concat('user ', id) AS username", "CAST(NULL AS STRING) AS nickname")
    paths = sinks.write_collections({"people": people}, str(tmp_path / "docs"))
    files = [p for p in (tmp_path / "docs/people").iterdir() if p.name.startswith("part-")]
    assert files and all(p.name.endswith(".json.gz") for p in files)
    assert sorted(spark.read.schema(people.schema).json(paths["people"]).collect()) == sorted(people.collect())
    assert "nickname" in spark.read.json(paths["people"]).columns
