"""Large JSON lines are stored compressed, with nothing missing."""

import pathlib

from pyspark.sql import functions as F

from merchantry import schemas
from merchantry.operators import generate
from merchantry.sources import sinks


def stored(path):
    return sum(p.stat().st_size for p in pathlib.Path(path).rglob("part-*"))


def test_generated_files_are_whole_and_packed(spark, tmp_path):
    t = {name: schemas.conform_to(spark.range(1, 40).selectExpr("id", *columns), "normalized", name) for name, columns in {
        "users": ["concat('ü\\n', id) AS username", "'user' AS role", "30 AS age"], "products": ["concat('p', id) AS title", "2.5 AS price"],
        "orders": ["id AS user_id", "'F' AS status", "3.0 AS total"]}.items()}
    facts = {r.table_name: r for r in generate.generate_files(t, str(tmp_path), 3000).collect()}
    for name, df in generate.generate_all(t, 3000).items():
        lines = df.select(F.to_json(F.struct("*")).alias("line"))
        size = lines.agg(F.sum(F.octet_length("line") + 1)).first()[0]
        r = facts[name]
        assert (r.row_count, r.size_bytes, r.stored_bytes) == (3000, size, stored(tmp_path / name)) and r.stored_bytes < size / 2.5
        assert spark.read.text(str(tmp_path / name)).exceptAll(lines).isEmpty()


def test_exported_facts_are_whole_and_packed(spark, tmp_path):
    fact = spark.range(5000).selectExpr("id AS fact_id", "id DIV 4 AS order_id", "cast(id % 7 AS decimal(18,2)) AS total_amount",
                                        "if(id % 3 = 0, NULL, 'F') AS order_status", "date '2024-01-01' AS day").coalesce(1)
    paths, ready = sinks.export_fact(fact, str(tmp_path)), sinks.export_ready(fact)
    for kind, path in paths.items():
        assert spark.read.schema(ready.schema).format(kind).load(path).exceptAll(ready).isEmpty()
    lines = ready.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("line"))
    assert spark.read.text(paths["json"]).exceptAll(lines).isEmpty()
    assert stored(paths["json"]) < lines.agg(F.sum(F.octet_length("line") + 1)).first()[0] / 4
