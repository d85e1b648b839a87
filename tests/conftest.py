import os
import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

TESTDATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tracelark.session import build_session

    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return TESTDATA


@pytest.fixture(scope="session")
def fixture_lines():
    """The documents of FIXTURES.md, then a copy, a broken line and an empty one."""
    text = (ROOT / "FIXTURES.md").read_text()
    documents = [line for line in text.splitlines() if line.startswith('{"transaction_id"')]
    return documents + [documents[0], "not json", ""]


@pytest.fixture(scope="session")
def fixture_raw(spark, fixture_lines):
    from pyspark.sql import functions as F

    from tracelark.sources import add_ingest_columns

    lines = spark.createDataFrame([(line,) for line in fixture_lines], "raw_json string")
    return add_ingest_columns(lines, ingest_ts=F.lit("2025-05-02 00:00:00").cast("timestamp"))
