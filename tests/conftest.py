import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from marram.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_of(frame) -> str:
    """The physical plan as text, before adaptive changes."""
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(frame) -> int:
    return plan_of(frame).count("Exchange hashpartitioning") + plan_of(frame).count(
        "Exchange rangepartitioning"
    ) + plan_of(frame).count("Exchange RoundRobinPartitioning")
