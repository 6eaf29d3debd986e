"""Subtotals, top-k, bags, sketches and types of a feed."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import bag, plan

from pyspark.sql import functions as F

from clinflow.operators import rollup, rows, sketches, top
from clinflow.schemas import CLAIMS, PATIENTS
from clinflow.sources import profile, views

FOLDER = "/root/testdata/sf0.001"


def facts(seed):
    """Claims that are in several rows and groups, with NULL dimensions and amounts."""
    draw = random.Random(seed)
    out = []
    for i in range(200):
        paid = draw.choice([None, 0.1 * draw.randrange(1000)])
        month = draw.choice([1, 2, None])
        out += [(f"c{i}", draw.choice(["x", "y", None]), month, paid) for _ in range(draw.randrange(1, 6))]
    return out


@pytest.mark.parametrize("sets", [rollup.rollup_sets, rollup.cube_sets])
def test_totals_count_a_claim_once(spark, sets):
    data = facts(3)
    dims = ["code", "month"]
    df = spark.createDataFrame(data, "claim_id string, code string, month int, paid double").repartition(5)
    got = rollup.totals_once(df, dims, sets(dims), ["claim_id"], ["paid"])
    want = defaultdict(dict)
    for claim_id, code, month, paid in data:
        for group in sets(dims):
            level = ("code" not in group) * 2 + ("month" not in group)
            want[level, code if "code" in group else None, month if "month" in group else None][claim_id] = paid
    expected = Counter()
    for key, claims in want.items():
        known = [p for p in claims.values() if p is not None]
        expected[(*key, len(claims), round(sum(known), 2) if known else None)] += 1
    assert Counter((r["level"], r["code"], r["month"], r["claims"], r["paid"]) for r in got.collect()) == expected
    assert "Expand" not in plan(got) and "Join" not in plan(got)


def test_totals_of_nothing(spark):
    df = spark.createDataFrame([], "claim_id string, code string, paid double")
    assert rollup.totals_once(df, ["code"], rollup.rollup_sets(["code"]), ["claim_id"], ["paid"]).collect() == []


def test_top_k_lets_k_rows_a_task_and_group_travel(spark):
    draw = random.Random(2)
    data = [(draw.choice("aab"), draw.choice([None, 1.0, 2.0, 3.0]), i) for i in range(500)]
    df = spark.createDataFrame(data, "g string, v double, id long").repartition(6)
    got = top.top_k(df, ["g"], "v", ["id"], 4)
    want = []
    for g in "ab":
        best = sorted((r for r in data if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))[:4]
        want += [(*r, n) for n, r in enumerate(best, 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    text = plan(got)
    # The plan ranks once before the shuffle, and passes on four rows of a group.
    partial, exchange = text.index("WindowGroupLimit"), text.index("Exchange")
    assert text.count("WindowGroupLimit") >= 2 and partial < exchange and "Partial" in text
    for k in (0, top.MOST + 1):
        with pytest.raises(ValueError):
            top.top_k(df, ["g"], "v", ["id"], k)


def test_bags(spark):
    draw = random.Random(4)
    one = [(draw.choice(["a", None]), draw.choice([1, 2, None])) for _ in range(200)]
    other = [(draw.choice(["a", None]), draw.choice([1, 3, None])) for _ in range(90)]
    left, right = (spark.createDataFrame(x, "s string, n int") for x in (one, other))
    minus = rows.except_all_rows(left, right.select("n", "s"))
    assert Counter(map(tuple, minus.collect())) == Counter(one) - Counter(other)
    assert Counter(map(tuple, rows.intersect_all_rows(left, right).collect())) == Counter(one) & Counter(other)
    assert bag(minus) == bag(left.exceptAll(right))
    many = spark.range(200_000).select(F.lit("x").alias("s"))
    assert rows.except_all_rows(many, many.limit(10)).count() == 199_990


@pytest.mark.parametrize("error", [0.01, 0.1])
def test_quantiles_hold_their_error(spark, error):
    draw = random.Random(6)
    data = [(i % 3, i % 17, draw.choice([None, float("nan"), 0.0, -draw.lognormvariate(0, 3), draw.lognormvariate(2, 4)])) for i in range(6000)]
    df = spark.createDataFrame(data, "g int, day int, v double").repartition(5)
    daily = sketches.quantile_sketches(df, ["g", "day"], "v", error)
    shares = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r["g"], r["share"]): r["value"] for r in sketches.merged_quantiles(daily, ["g"], shares, error).collect()}
    for g in range(3):
        values = sorted(v for group, _, v in data if group == g and v is not None and v == v)
        for share in shares:
            true = values[max(1, -(-round(share * len(values) * 1e9) // 10**9)) - 1]
            assert abs(got[g, share] - true) <= error * abs(true) * 1.000001


def test_distinct_counts_at_scale_read_no_rows(spark, tmp_path):
    claims = views.claims(spark, "/root/testdata/sf0.1").filter("service_date is not null and member_id is not null")
    daily = str(tmp_path / "daily")
    sketches.distinct_sketches(claims.withColumn("year", F.year("service_date")), ["year", "service_date"], "member_id").write.parquet(daily)
    merged = sketches.merged_distinct(spark.read.parquet(daily), ["year"])
    text = plan(merged)
    assert "orders" not in text and text.count("Scan parquet") == 2  # one in the tree, one in the details
    exact = {r["year"]: r["n"] for r in claims.groupBy(F.year("service_date").alias("year")).agg(F.count_distinct("member_id").alias("n")).collect()}
    for row in merged.collect():
        assert abs(row["estimate"] - exact[row["year"]]) <= 4 * sketches.DISTINCT_ERROR * exact[row["year"]] + 1


def test_types_of_our_feeds(spark):
    """Clean feeds propose the declared types; a value that does not fit turns a column to text."""
    claims = views.claims(spark, FOLDER).filter("service_date is not null")
    as_text = claims.select([F.col(n).cast("string").alias(n) for n in claims.columns])
    assert profile.proposed_schema(as_text) == CLAIMS
    patients = views.patients(spark, FOLDER)
    assert profile.proposed_schema(patients.select([F.col(n).cast("string").alias(n) for n in patients.columns])) == PATIENTS
    broken = profile.profile(views.feed_claims(spark, FOLDER))
    assert plan(broken).count("Scan parquet") == 2 and not re.search("hashpartitioning", plan(broken))
    assert {r["type"] for r in broken.collect() if r["column_name"] in ("service_date", "paid_amount")} == {"string"}


def test_lattice(spark):
    columns = {
        "whole": (["1", " -20 ", None, ""], "bigint"), "big": (["9" * 19], "double"), "padded": (["007", "12"], "string"), "mixed": (["1", "2.5"], "double"),
        "exponent": (["1e3"], "double"), "words": (["NaN"], "string"), "day": (["2020-02-29"], "date"), "no_day": (["2021-02-29"], "string"),
        "nothing": ([None, " "], "string"), "a_code": (["12"], "string"), "zero": (["0", "0.5"], "double"), "day_or_number": (["2020-01-01", "5"], "string"),
    }
    size = max(len(values) for values, _ in columns.values())
    data = [tuple(values[i] if i < len(values) else None for values, _ in columns.values()) for i in range(size)]
    got = {r["column_name"]: r for r in profile.profile(spark.createDataFrame(data, ", ".join(f"{n} string" for n in columns))).collect()}
    assert {name: r["type"] for name, r in got.items()} == {name: kind for name, (_, kind) in columns.items()}
    assert (got["whole"]["filled"], got["whole"]["empty"], got["whole"]["longest"]) == (2, 2, 5)
    empty = profile.profile(spark.createDataFrame([], "a string"))
    assert [tuple(r) for r in empty.collect()] == [("a", 0, 0, 0, "string")]
