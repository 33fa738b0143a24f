from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stayledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # tiny inputs: interpreted execution saves compiling each plan
    session = local_session(
        "tests",
        "4",
        spark__sql__shuffle__partitions="3",
        spark__sql__codegen__wholeStage="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a DataFrame from rows and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def as_map(df, key, value):
    return {r[key]: r[value] for r in df.collect()}
