import os
import sys

import pytest
from llm_rows import corpus

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from sheetdoc.session import get_session

    yield get_session("local[4]", "sheetdoc-tests", {"spark.sql.shuffle.partitions": "2"})


@pytest.fixture(scope="session")
def documents(spark):
    return corpus()
