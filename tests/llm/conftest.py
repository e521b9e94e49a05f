import pathlib
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(pathlib.Path(__file__).parent))

from llm_rows import AWKWARD  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not pathlib.Path(SF_DIR).exists():
        pytest.skip("the given tables are not here")
    return SF_DIR


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text, source) with columns whose names clash with the operators' own and with each other."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("Text", T.IntegerType()), T.StructField("size", T.StringType()), T.StructField("in0", T.StringType()),
        T.StructField("window", T.StringType()), T.StructField("component", T.LongType()), T.StructField("score", T.DoubleType()),
    ])

    def build(rows):
        return spark.createDataFrame([(i, t, s, 7, "x", None, "w", 5, 0.5) for i, t, s in rows], schema)
    return build


@pytest.fixture
def awkward(documents):
    return documents(AWKWARD)


@pytest.fixture
def nothing(documents):
    return documents([])
