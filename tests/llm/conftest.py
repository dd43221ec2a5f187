from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import fixtures  # noqa: E402
from saltmill.llm.common import prepare  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    prepare(spark)
    return fixtures.table(spark, fixtures.awkward())


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
