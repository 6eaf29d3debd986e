"""Every registered query against its SQL text in DuckDB, and the shape of the plans that matter at scale."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from conftest import plan

import __spark_entry__ as contract
from clinflow.operators import star
from clinflow.operators.joins import JoinLimits
from clinflow.plans import queries, stages
from clinflow.plans.oracles import ORACLES
from clinflow.sources import views

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def rows(table):
    names = sorted(table.column_names)
    return Counter(zip(*[[str(v) for v in table[name].to_pylist()] for name in names]))


def test_each_query_has_its_sql():
    assert set(queries.REGISTERED) == set(ORACLES)
    assert set(queries.REGISTERED) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.REGISTERED))
def test_query_equals_sql(spark, oracle, name):
    got = contract.queries()[name](spark, FOLDER)
    want = oracle.sql(contract.oracle_sql()[name])
    assert {f.name: TYPES[f.dataType.simpleString()] for f in got.schema} == dict(
        zip(want.columns, map(str, want.types))
    )
    assert rows(got.toArrow()) == rows(want.to_arrow_table())
    # A few local rows, such as the hot keys of a join, are a scan of their own name.
    text = plan(got).replace("applySchemaToPythonRDD", "")
    for unwanted in ("Python", "CartesianProduct", "NestedLoop"):
        assert unwanted not in text


def test_entry(spark):
    assert contract.entry(spark).count() == 8642


def test_quality_pass_scans_once_without_shuffle(spark):
    text = plan(contract.queries()["dq_claims_quarantine"](spark, FOLDER))
    assert text.count("Scan parquet") == 2  # one in the tree, one in the details
    assert "Exchange" not in text and "Join" not in text


def test_dedup_and_except_combine_before_the_shuffle(spark):
    text = plan(contract.queries()["dedup_lines"](spark, FOLDER))
    assert "partial_max" in text and text.count("Arguments: hashpartitioning") == 1
    text = plan(contract.queries()["except_rows"](spark, FOLDER))
    assert "Join" not in text and text.count("Arguments: hashpartitioning") == 1


def test_pruning_reaches_the_scan(spark):
    text = plan(contract.queries()["project_columns"](spark, FOLDER))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text
    text = plan(contract.queries()["filter_negative"](spark, FOLDER))
    assert "LessThan(c_acctbal,0.0)" in text


def test_claims_do_not_shuffle_for_the_fact(spark):
    """With small dimensions the claims meet broadcasts only."""
    text = plan(contract.queries()["fact_claims"](spark, FOLDER))
    assert text.count("BroadcastHashJoin LeftOuter BuildRight") == 4


@pytest.mark.parametrize("partitions", ["1", "4", "64"])
def test_results_do_not_depend_on_the_number_of_partitions(spark, oracle, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for name in ("curate_claims", "dim_member", "dim_diagnosis", "fact_claims"):
            got = contract.queries()[name](spark, FOLDER).toArrow()
            assert rows(got) == rows(oracle.sql(contract.oracle_sql()[name]).to_arrow_table())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


ROUTES = {
    "plain shuffle": JoinLimits(broadcast_bytes=-1, hot_rows=10**9, sample_fraction=1.0),
    "hot keys": JoinLimits(broadcast_bytes=-1, hot_rows=20, sample_fraction=1.0),
}


@pytest.mark.parametrize("route", ROUTES)
def test_whole_way_on_the_routes_for_large_tables(spark, oracle, route):
    limits = ROUTES[route]
    claims, _ = stages.curate_claims(views.claims(spark, FOLDER))
    encounters, _ = stages.curate_encounters(views.encounters(spark, FOLDER))
    raw = {"claims": views.claims(spark, FOLDER)}
    safe = stages.mask(claims, views.patients(spark, FOLDER), encounters, queries.SALT, limits, raw)
    visits = star.fold_visits(safe["encounters"])
    dims = star.build_dims(safe["claims"], safe["patients"], visits)
    fact = star.build_fact(safe["claims"], visits, dims, limits=limits)
    assert rows(fact.toArrow()) == rows(oracle.sql(contract.oracle_sql()["fact_claims"]).to_arrow_table())
    text = plan(fact)
    assert "__left_cell" in text if route == "hot keys" else "SortMergeJoin LeftOuter" in text
    assert "NestedLoop" not in text and "CartesianProduct" not in text
