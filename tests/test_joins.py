"""Every route of the skew-proof join against brute force on the same rows."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import bag, plan
from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F

from clinflow.operators import joins
from clinflow.operators.joins import JoinLimits, spread_join

BROADCAST = JoinLimits()
PLAIN = JoinLimits(broadcast_bytes=-1, hot_rows=10_000, sample_fraction=1.0)
HOT = JoinLimits(broadcast_bytes=-1, hot_rows=3, sample_fraction=1.0)
# Hot rows of the right side fit, the whole right side does not.
HOT_FITS = JoinLimits(broadcast_bytes=200, hot_rows=3, sample_fraction=1.0)

LEFT = [(i, key) for i, key in enumerate([1] * 12 + [2] * 2 + [None] * 7 + [9] * 5 + [4])]
UNIQUE = [(1, "one"), (2, "two"), (3, "three"), (4, "four"), (None, "none")]
MANY = [(1, "a"), (1, "b"), (2, "c")] + [(4, f"d{i}") for i in range(9)] + [(None, "none"), (3, "e")]


def expected(left, right, how, null_safe=False):
    out = []
    for i, key in left:
        met = [v for k, v in right if k == key and (key is not None or null_safe)]
        if how == "left_anti":
            out += [] if met else [(i, key)]
        else:
            out += [(i, key, v) for v in met or [None]]
    return Counter(tuple(map(repr, row)) for row in out)


def frames(spark, left, right):
    return spark.createDataFrame(left, "i int, k int"), spark.createDataFrame(right, "k int, v string")


@pytest.mark.parametrize("limits", [BROADCAST, PLAIN, HOT, HOT_FITS])
@pytest.mark.parametrize("spread_by", [(), ("i",)])
@pytest.mark.parametrize("null_safe", [False, True])
def test_lookup(spark, limits, spread_by, null_safe):
    left, right = frames(spark, LEFT, UNIQUE)
    got = joins.lookup(left, right, "k", limits=limits, spread_by=spread_by, null_safe=null_safe)
    assert got.columns == ["i", "k", "v"]
    assert bag(got) == expected(LEFT, UNIQUE, "left", null_safe)


@pytest.mark.parametrize("limits", [BROADCAST, PLAIN, HOT, HOT_FITS])
@pytest.mark.parametrize("spread_by", [(), ("i",)])
def test_anti_join(spark, limits, spread_by):
    left, right = frames(spark, LEFT, MANY)
    got = joins.anti_join(left, right, "k", limits=limits, spread_by=spread_by)
    assert bag(got) == expected(LEFT, MANY, "left_anti")


@pytest.mark.parametrize("limits", [BROADCAST, PLAIN, HOT])
def test_many_to_many(spark, limits):
    left, right = frames(spark, LEFT, MANY)
    got = spread_join(left, right, "k", spread_by=["i"], limits=limits)
    assert bag(got) == expected(LEFT, MANY, "left")


def test_many_to_many_without_row_identity(spark):
    left, right = frames(spark, LEFT, MANY + [(100 + i, "cold") for i in range(50)])
    roomy = JoinLimits(broadcast_bytes=600, hot_rows=3, sample_fraction=1.0)
    assert bag(spread_join(left, right, "k", limits=roomy)) == expected(LEFT, MANY, "left")
    assert bag(spread_join(left, right, "k", limits=HOT)) == expected(LEFT, MANY, "left")


@pytest.mark.parametrize("null_safe", [False, True])
def test_copies_on_both_sides_without_row_identity(spark, null_safe):
    """Hot keys on both sides, rows that nothing tells apart, NULL among the keys, and no room to broadcast."""
    left_rows = [(0, 1)] * 30 + [(0, None)] * 20 + [(5, 2)]
    right_rows = [(1, "a")] * 8 + [(None, "n")] * 9 + [(2, "c"), (3, "d")]
    left, right = frames(spark, left_rows, right_rows)
    got = spread_join(left, right, "k", null_safe=null_safe, limits=HOT)
    assert bag(got) == expected(left_rows, right_rows, "left", null_safe)
    assert "NestedLoop" not in plan(got) and "CartesianProduct" not in plan(got)


def test_anti_join_with_a_hot_right_side_that_repeats(spark):
    left, right = frames(spark, LEFT, MANY)
    got = spread_join(left, right.select("k"), "k", "left_anti", spread_by=["i"], limits=HOT)
    assert bag(got) == expected(LEFT, MANY, "left_anti")


def test_more_keys_than_any_bound_have_many_rows(spark):
    """All keys pass ``hot_rows``; none owns enough of the whole to be worth a route of its own."""
    left_rows = [(i, i % 500) for i in range(2500)]
    right_rows = [(k, v) for k in range(0, 500, 2) for v in ("a", "b", "c", "d")]
    left, right = frames(spark, left_rows, right_rows)
    assert len(joins.hot_keys(left, ["k"], HOT)) <= 4 * 8
    for spread_by in ((), ("i",)):
        assert bag(spread_join(left, right, "k", spread_by=spread_by, limits=HOT)) == expected(left_rows, right_rows, "left")


def test_map_columns_need_row_identity_whatever_the_size(spark):
    left = spark.createDataFrame([(1, {"a": 1})], "k int, m map<string,int>")
    right = spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(TypeError, match="spread_by"):
        spread_join(left, right, "k")


def test_copies_of_one_row_do_not_move(spark):
    """Without row identity the rows of a hot key join a broadcast and skip the shuffle."""
    left, right = frames(spark, [(0, 1)] * 40 + [(i, i) for i in range(2, 9)], UNIQUE)
    got = joins.lookup(left, right, "k", limits=HOT)
    assert "BroadcastHashJoin" in plan(got) and "Union" in plan(got)
    assert bag(got)[("0", "1", "'one'")] == 40


key = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(key, max_size=25), st.lists(st.tuples(key, st.sampled_from("abc")), max_size=15, unique=True))
def test_grid_meets_each_pair_once(spark, keys, right_rows):
    left_rows = list(enumerate(keys))
    left, right = frames(spark, left_rows, right_rows)
    limits = JoinLimits(broadcast_bytes=-1, hot_rows=2, sample_fraction=1.0)
    got = spread_join(left, right, "k", spread_by=["i"], limits=limits)
    assert bag(got) == expected(left_rows, right_rows, "left")


def test_hot_keys_by_rows_and_by_weight(spark):
    left, _ = frames(spark, LEFT, MANY)
    limits = JoinLimits(hot_rows=5, sample_fraction=1.0)
    assert joins.hot_keys(left, ["k"], limits) == {(1,): 12, (None,): 7, (9,): 5}
    weighted = spark.createDataFrame([(1, 4), (1, 4), (2, 3)], "k int, copies int")
    assert joins.hot_keys(weighted, ["k"], limits, weight="copies") == {(1,): 8}


def test_measured_bytes(spark):
    df = spark.createDataFrame([("abcd", 1), (None, 2)], "s string, n int")
    assert joins.measured_bytes(df, enough=1000) == 2 * 16 + 4 + 2 * 8
    assert joins.measured_bytes(df, enough=10) > 10
    assert joins.measured_bytes(df.limit(0), enough=10) == 0


def test_wide_nested_columns_are_measured(spark):
    wide = spark.createDataFrame([(i, list(range(2000))) for i in range(3)], "k int, v array<int>")
    assert joins.measured_bytes(wide, enough=1 << 20) > 3 * 2000
    left = spark.createDataFrame([(i % 3, i) for i in range(9)], "k int, i int")
    got = spread_join(left, wide, "k", spread_by=["i"], limits=JoinLimits(broadcast_bytes=10_000))
    assert "SortMergeJoin" in plan(got) or "ShuffledHashJoin" in plan(got)


def largest_share(df):
    """Of all rows, the share that came out of one task of the last shuffle."""
    sizes = [row["count"] for row in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


@pytest.fixture
def fixed_partitions(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("hot", [1, None])
def test_a_third_of_all_rows_under_one_key_is_spread(spark, fixed_partitions, hot):
    left = spark.createDataFrame([(i, hot if i % 3 == 0 else i) for i in range(6000)], "i int, k int")
    right = spark.createDataFrame([(k, "v") for k in range(3000)], "k int, v string")
    plain = JoinLimits(broadcast_bytes=-1, hot_rows=10**6, sample_fraction=1.0)
    spread = JoinLimits(broadcast_bytes=-1, hot_rows=50, sample_fraction=1.0)
    one_task = joins.lookup(left, right, "k", limits=plain)
    cells = joins.lookup(left, right, "k", spread_by=["i"], limits=spread)
    assert largest_share(one_task) > 1 / 3
    assert largest_share(cells) < 0.12
    assert bag(one_task) == bag(cells)


def test_a_third_of_the_right_rows_under_one_key_is_spread(spark, fixed_partitions):
    left = spark.createDataFrame([(i, i % 1000) for i in range(2000)], "i int, k int")
    right = spark.createDataFrame([(1 if i % 3 == 0 else i % 1000, i) for i in range(6000)], "k int, v int")
    plain = JoinLimits(broadcast_bytes=-1, hot_rows=10**6, sample_fraction=1.0)
    spread = JoinLimits(broadcast_bytes=-1, hot_rows=50, sample_fraction=1.0)
    one_task = spread_join(left, right, "k", spread_by=["i"], limits=plain)
    cells = spread_join(left, right, "k", spread_by=["i"], limits=spread)
    assert largest_share(one_task) > 1 / 4
    assert largest_share(cells) < 0.12
    assert bag(one_task) == bag(cells)


def test_a_sample_finds_what_owns_a_third(spark):
    df = spark.range(60_000).selectExpr("if(id % 3 = 0, -1, id) as k")
    found = joins.hot_keys(df, ["k"], JoinLimits(hot_rows=5_000, sample_fraction=0.05))
    assert list(found) == [(-1,)] and 15_000 < found[(-1,)] < 25_000
