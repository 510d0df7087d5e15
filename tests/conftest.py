import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from pagemill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", "4", **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture
def pages(spark):
    def make(*texts, titles=None):
        rows = [(f"p{i}", (titles or [f"T{j}" for j in range(len(texts))])[i], t) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "page_key string, title string, text string")

    return make
