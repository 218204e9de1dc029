import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from visitrisk.session import session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__sql__maxMetadataStringLength="20000",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def settings(spark):
    """Set session values for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture
def plan_of():
    """The executed physical plan as text."""

    def executed(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return executed
