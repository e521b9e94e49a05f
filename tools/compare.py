"""Run registered queries and their SQL counterparts side by side: python tools/compare.py SF_DIR [name part ...]"""

from __future__ import annotations

import math
import pathlib
import sys
import time
import traceback

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from merchantry.session import get_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, bool) or v is None:
        return str(v)
    return repr(v)


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql: str | None, sf_dir: str) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    got_columns, got = df.columns, [tuple(r) for r in df.collect()]
    if sql is None:
        return True, f"{len(got)} rows, no SQL"
    result = con.execute(sql)
    want_columns, want = [d[0] for d in result.description], result.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return False, f"columns {sorted(set(got_columns) ^ set(want_columns))}"
    a, b = canonical(got_columns, got), canonical(want_columns, want)
    if a != b:
        only_a, only_b = [r for r in a if r not in set(b)][:2], [r for r in b if r not in set(a)][:2]
        return False, f"{len(a)} vs {len(b)} rows\n   {sorted(got_columns)}\n   spark {only_a}\n   sql   {only_b}"
    types = {c: t for c, t in df.dtypes}
    return True, f"{len(got)} rows" + (" EMPTY" if not got else "") + ("" if types else "")


def main() -> None:
    from merchantry.registry import ORACLES, QUERIES

    sf_dir, parts = sys.argv[1], sys.argv[2:]
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name, query in QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            ok, text = compare(spark, con, query, ORACLES.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001
            ok, text = False, "".join(traceback.format_exception_only(error))[:1500]
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {text}", flush=True)
        failed += [] if ok else [name]
    print(f"failed: {failed}")


if __name__ == "__main__":
    main()
