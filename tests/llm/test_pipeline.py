import importlib.util
import pathlib

import corpus_pipeline
import pytest
from llm_rows import AWKWARD  # noqa: F401

from merchantry.llm.registry import ORACLES, QUERIES
from merchantry.llm.rows import kept, table

ROOT = pathlib.Path(__file__).resolve().parents[2]


def load(name, path):
    spec = importlib.util.spec_from_file_location(name, ROOT / path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


compare = load("compare", "tools/compare.py")
entry = load("spark_entry", "__spark_entry__.py")


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_sql_counterparts_are_sql():
    assert sorted(ORACLES) == ["op11_prefix_trie", "op12_exact_dedup", "op13_conversation_repair", "op1_source_mixing", "op6_line_dedup"]
    assert all(isinstance(sql, str) for sql in entry.oracle_sql().values())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, sf_dir, name):
    ok, text = compare.compare(spark, compare.connect(sf_dir), QUERIES[name], ORACLES[name], sf_dir)
    assert ok, text


def test_stages(spark, sf_dir):
    """Each stage on its own input: columns, rows that go, and the tokens of what is left."""
    docs = table(spark, sf_dir, "documents")
    columns, frames = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(kept(stage(spark, frames[-1], sf_dir), f"test-{name}"))
    start, calm, lined, single, mixed, last = frames
    assert [f.columns for f in frames[:-1]] == [columns] * 5
    toxic = {r.doc_id for r in QUERIES["op9_toxicity"](spark, sf_dir).filter("predicted = 1").collect()}
    assert {r.doc_id for r in calm.collect()} == {r.doc_id for r in start.collect()} - toxic
    assert lined.count() == calm.count()
    assert {r.doc_id for r in single.collect()} == {r.doc_id for r in near_kept(lined).collect()}
    assert last.count() == mixed.count() and last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    whole = sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert whole == sorted(tuple(r) for r in last.collect())


def near_kept(docs):
    from merchantry.llm.near_dedup import near_texts
    return near_texts(docs).filter("kept")


def test_awkward_documents(spark, sf_dir, awkward, nothing):
    for docs in (awkward, nothing):
        frame = docs
        for _, stage in corpus_pipeline.STAGES:
            frame = kept(stage(spark, frame, sf_dir), "test-awkward")
        assert frame.count() >= 0
