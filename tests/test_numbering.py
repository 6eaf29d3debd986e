from __future__ import annotations

import pytest
from conftest import plan

from clinflow.operators.numbering import number_rows
from clinflow.operators.star import build_dim, build_date_dim


def numbered(df, rows_per_task, key="k"):
    return {row[key]: row["sk"] for row in number_rows(df, key, "sk", rows_per_task).collect()}


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_range_numbering_equals_one_window(spark, partitions):
    values = [f"key-{i * 7919 % 5000:05d}" for i in range(5000)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "k string").repartition(partitions)
    want = {v: i for i, v in enumerate(sorted(v for v in values if v), start=1)} | {None: 5001}
    assert numbered(df, rows_per_task=10_000) == want
    assert numbered(df, rows_per_task=300) == want


def test_more_ranges_than_keys_and_no_keys(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "k string")
    assert numbered(df, rows_per_task=1) == {"a": 1, "b": 2, None: 3}
    assert numbered(df.limit(0), rows_per_task=1) == {}


def test_many_keys_pass_no_single_task(spark):
    keys = spark.range(2000).selectExpr("cast(id as string) as k")
    assert "SinglePartition" in plan(number_rows(keys, "k", "sk", rows_per_task=5000))
    many = plan(number_rows(keys, "k", "sk", rows_per_task=100))
    assert "Window" not in many and "SinglePartition" not in many
    assert "hashpartitioning" not in many and "BroadcastHashJoin" in many


def test_keys_do_not_change_when_read_again(spark):
    df = number_rows(spark.range(2000).selectExpr("cast(id as string) as k"), "k", "sk", rows_per_task=100)
    assert sorted(df.collect()) == sorted(df.repartition(3).collect())
    assert df.schema["sk"].dataType.simpleString() == "bigint"


def test_dim_keeps_one_row_per_natural_key(spark):
    df = spark.createDataFrame([("m2", "M"), ("m1", "M"), ("m1", "F"), (None, "F"), (None, None)], "k string, g string")
    dim = build_dim(df, ["k", "g"], "sk")
    assert dim.columns == ["k", "g", "sk"]
    assert sorted(map(tuple, dim.collect()), key=lambda r: r[2]) == [("m1", "F", 1), ("m2", "M", 2), (None, "F", 3)]


def test_date_dim_has_observed_dates_only(spark):
    df = spark.sql("select explode(array(date'2025-03-31', date'2024-02-29', null, date'2025-03-31')) as d")
    got = [tuple(row) for row in build_date_dim(df, "d").orderBy("date_sk").collect()]
    assert [(str(d), y, m, n, sk) for d, y, m, n, sk in got] == [
        ("2024-02-29", 2024, 2, 29, 1),
        ("2025-03-31", 2025, 3, 31, 2),
    ]
