import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from palaver.llm.common import findable  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    findable(spark)
