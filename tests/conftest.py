import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from foliant.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "foliant-tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Value of a column expression over one row of the given strings."""

    def evaluate(expression, **values):
        fields = ", ".join(f"{name} string" for name in values) or "x string"
        row = tuple(values.values()) or ("",)
        return spark.createDataFrame([row], fields).select(expression.alias("v")).first()["v"]

    return evaluate
