import random

import numpy as np
import pyarrow as pa

from merchantry.llm.groups import components, forest, in_groups


def test_components(spark):
    rnd = random.Random(2)
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, 400 + k) for k in range(50)] + [(rnd.randrange(1000, 1200), rnd.randrange(1000, 1200)) for _ in range(150)]
    edges += [(7, 7), (9, 8), (8, 9)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges for x in e if e[0] != e[1]}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest():
    chosen = forest(np.array([0, 1, 0, 3]), np.array([1, 2, 2, 4]), 5)
    assert chosen.tolist() == [True, True, False, True]


def test_groups_span_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(1000).selectExpr("id % 37 as k", "id % 2 as j", "id")
        out = in_groups(df, ["k", "j"], "k long, n long, total long", lambda t: [pa.RecordBatch.from_arrays(
            [t.column("k").combine_chunks().slice(0, 1), pa.array([t.num_rows]), pa.array([sum(t.column("id").to_pylist())])], ["k", "n", "total"])])
        rows = out.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(rows) == 74 and sum(r.n for r in rows) == 1000 and sum(r.total for r in rows) == 499500
