import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from textloom.session import get_spark  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("tests", master="local[4]", partitions=4,
                  spark__checkpoint__dir=tempfile.mkdtemp(prefix="textloom-test-"),
                  spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture
def docs_of(spark):
    """A documents table made of the given texts, ids from 0."""
    def make(texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return make


@pytest.fixture
def column_of(docs_of):
    """Values of a column expression over texts, in order."""
    def run(texts, expr):
        rows = docs_of(texts).select("doc_id", expr.alias("v")).collect()
        return [r.v for r in sorted(rows)]
    return run
