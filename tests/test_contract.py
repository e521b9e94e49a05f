"""Every registered query against its SQL counterpart on the smallest given tables."""

import importlib.util
import pathlib

import pytest

from merchantry.registry import ORACLES, QUERIES

ROOT = pathlib.Path(__file__).resolve().parents[1]
SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="the given tables are not here")


def load(name, path):
    spec = importlib.util.spec_from_file_location(name, ROOT / path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


compare = load("compare", "tools/compare.py")
entry = load("spark_entry", "__spark_entry__.py")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_entry(spark):
    assert entry.entry(spark).count() == 50
    assert set(entry.queries()) >= set(QUERIES) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, con, name):
    ok, text = compare.compare(spark, con, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert ok, text
