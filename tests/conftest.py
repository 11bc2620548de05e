import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from edgeledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a frame as sorted plain tuples."""

    def collect(frame, *columns):
        picked = frame.select(*columns) if columns else frame
        return sorted((tuple(row) for row in picked.collect()), key=repr)

    return collect


def executed_plan(frame) -> str:
    """The final adaptive plan of a frame after one run."""
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]
