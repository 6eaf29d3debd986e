from __future__ import annotations

import contextlib
import io
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("clinflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def bag(df: DataFrame) -> Counter:
    """The rows of a frame as a multiset, columns in name order."""
    names = sorted(df.columns)
    return Counter(tuple(repr(row[name]) for name in names) for row in df.select(*names).collect())


def plan(df: DataFrame) -> str:
    """The physical plan as ``explain`` prints it."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
