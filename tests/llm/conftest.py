import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import EXTRA, TEXTS  # noqa: E402


@pytest.fixture(scope="session")
def documents(spark):
    rows = [(i, t, "en", "s", len(t or ""), 1, 2, 3, True, False, 0.5, 1, 1, "b", "i") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, " + EXTRA).repartition(3)


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.where("false")
