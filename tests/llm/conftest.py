import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_data import CLASHING, odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def odd_docs(spark):
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([r + ("?",) * (len(CLASHING) - 1) + (None,) for r in odd_rows()], schema).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
