import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillstream.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """A DataFrame from rows and a DDL schema."""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


@pytest.fixture
def rows():
    """The rows of a DataFrame as a sorted list of tuples."""

    def get(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

    return get


@pytest.fixture
def plan():
    """The physical plan as text; ``run`` runs the query first, so that it is the final plan."""

    def text(df, run=False):
        execution = df._jdf.queryExecution()
        if run:
            df._jdf.collectToPython()
        return execution.executedPlan().toString()

    return text
