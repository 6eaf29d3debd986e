from __future__ import annotations

import pytest
from conftest import bag
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from clinflow.operators import rows

ROWS = [(1, "a", 1.0), (1, "a", None), (1, "b", None), (None, "a", 2.0), (None, "a", 3.0), (2, None, None)]


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_keep_one_does_not_depend_on_partitioning(spark, partitions):
    df = spark.createDataFrame(ROWS * 5, "k int, s string, x double").repartition(partitions)
    kept = rows.keep_one(df, ["k"])
    assert kept.columns == ["k", "s", "x"]
    assert bag(kept) == bag(spark.createDataFrame([(1, "b", None), (None, "a", 3.0), (2, None, None)], kept.schema))


def test_keep_one_with_all_columns_as_key(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (None, 2)], "a int, b int")
    assert rows.keep_one(df, ["a", "b"]).count() == 2


value = st.one_of(st.none(), st.integers(0, 2))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(value, value), max_size=20), st.lists(st.tuples(value, value), max_size=10))
def test_except_treats_nulls_as_equal(spark, mine, removed):
    left = spark.createDataFrame(mine, "a int, b int")
    right = spark.createDataFrame(removed, "a int, b int")
    got = {tuple(row) for row in rows.except_rows(left, right).collect()}
    assert got == set(mine) - set(removed)
    assert rows.except_rows(left, right).count() == len(got)


def test_union_matches_by_name(spark):
    left = spark.createDataFrame([(1, 2)], "a int, b int")
    right = left.select(F.col("b").alias("b"), F.col("a").alias("a"))
    assert bag(rows.union_rows(left, right, right)) == {("1", "2"): 3}
