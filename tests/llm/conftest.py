import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parents[1])]


@pytest.fixture(scope="session")
def text_spark(spark):
    from sievemark.llm.inputs import importable

    importable(spark)
    return spark
