from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from newsmart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A fresh folder under the shared one."""
    from newsmart.session import scratch_path

    return scratch_path(spark, "test").removeprefix("file:")


def plan_of(frame) -> str:
    """Physical plan, as finally run if the frame has been run."""
    return frame._jdf.queryExecution().executedPlan().toString()


def stamp(text: str):
    from pyspark.sql import functions as F

    return F.lit(text).cast("timestamp")


def rows_read(frame) -> int:
    """Rows that came out of the widest scan of a frame that has been run."""
    found = []

    def walk(plan) -> None:
        name = plan.nodeName()
        if name.startswith("Scan"):
            width = len(plan.schema().fieldNames())
            found.append((width, plan.metrics().apply("numOutputRows").value()))
        if name == "AdaptiveSparkPlan":
            walk(plan.executedPlan())
        elif "QueryStage" in name:
            walk(plan.plan())
        children = plan.children().iterator()
        while children.hasNext():
            walk(children.next())

    walk(frame._jdf.queryExecution().executedPlan())
    return max(found)[1]
