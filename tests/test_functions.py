from __future__ import annotations

import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from clinflow.functions import columns as c


def one(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row.out for row in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_filled_is_never_null(spark):
    assert one(spark, ["a", "", "  ", " a ", "\t", None], "string", c.is_filled) == [
        True,
        False,
        False,
        True,
        True,
        False,
    ]
    assert one(spark, [0, None], "int", c.is_filled) == [True, False]


def test_negative_is_never_null(spark):
    values = [-0.01, 0.0, -0.0, 3.0, None, float("nan"), float("-inf")]
    assert one(spark, values, "double", c.is_negative) == [True, False, False, False, False, False, True]
    assert one(spark, ["-3", " -3 ", "x", None], "string", c.is_negative) == [True, True, False, False]


def test_codes_are_trimmed_and_upper(spark):
    assert one(spark, [" e11.9 ", "i10", None, ""], "string", c.clean_code) == ["E11.9", "I10", None, ""]


def test_bad_dates_and_amounts_become_null(spark):
    assert one(spark, ["2025-01-31", "2025-02-30", "soon", "", None], "string", c.as_date) == [
        date(2025, 1, 31),
        None,
        None,
        None,
        None,
    ]
    assert one(spark, ["1.5", "1,5", None], "string", c.as_amount) == [1.5, None, None]


def test_member_key_is_salted_sha256_and_null_for_null(spark):
    key = hashlib.sha256(b"M1||pepper").hexdigest()
    assert one(spark, ["M1", None], "string", lambda v: c.member_key(v, "pepper")) == [key, None]
    number = hashlib.sha256(b"7||pepper").hexdigest()
    assert one(spark, [7], "bigint", lambda v: c.member_key(v, "pepper")) == [number]
    with pytest.raises(ValueError, match="salt"):
        c.member_key(F.lit("M1"), "")


def test_first_code_takes_any_code_unless_told_otherwise(spark):
    df = spark.createDataFrame([("UNKNOWN", "I10"), ("", "I10"), (None, "I10"), ("A", None)], "own string, other string")
    plain = df.select(c.first_code(F.col("own"), F.col("other")).alias("code"))
    assert [r.code for r in plain.collect()] == ["UNKNOWN", "", "I10", "A"]
    strict = df.select(c.first_code(F.col("own"), F.col("other"), missing=("", "UNKNOWN")).alias("code"))
    assert [r.code for r in strict.collect()] == ["I10", "I10", "I10", "A"]
