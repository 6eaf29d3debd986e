"""The given tables seen as claims, patients and encounters.

They hold no NULLs, so the views plant the defects the operators are there for: missing and blank
members, missing dates, negative amounts, unclean and missing codes. Every row of a table is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def claims(spark: SparkSession, folder: str) -> DataFrame:
    """One claim per order."""
    order = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    member = F.when(order % 25 == 0, None).when(order % 25 == 1, "  ").otherwise(_text("o_custkey"))
    return table(spark, folder, "orders").select(
        _text(order).alias("claim_id"),
        member.alias("member_id"),
        _text(order % 97).alias("provider_id"),
        F.when(order % 101 != 0, F.col("o_orderdate").cast("date")).alias("service_date"),
        F.when(order % 50 == 7, -10.0).otherwise(F.col("o_totalprice")).alias("paid_amount"),
        F.col("o_totalprice").alias("allowed_amount"),
        F.when(status != "P", F.concat(F.lit(" "), F.lower(status))).alias("icd10_code"),
        F.when(order % 5 != 0, F.col("o_orderpriority")).alias("cpt_code"),
    )


def claims_with_strangers(spark: SparkSession, folder: str) -> DataFrame:
    """Claims of which some name a member that no patient record knows."""
    stranger = F.col("claim_id").cast("long") % 20 == 3
    member = F.when(stranger, F.concat(F.lit("X"), "member_id")).otherwise(F.col("member_id"))
    return claims(spark, folder).withColumn("member_id", member)


def patients(spark: SparkSession, folder: str) -> DataFrame:
    """One patient per customer."""
    return table(spark, folder, "customer").select(
        _text("c_custkey").alias("patient_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.date_add(F.lit("1950-01-01").cast("date"), F.col("c_nationkey") * 365).alias("dob"),
        F.lpad(_text("c_nationkey"), 5, "0").alias("zip"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
    )


def patients_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """All patients; some a second time with the other gender, and some more records without an id."""
    known = patients(spark, folder)
    number = F.col("patient_id").cast("long")
    other = known.filter(number % 30 == 1).withColumn("gender", F.when(F.col("gender") == "F", "M").otherwise("F"))
    nameless = known.filter(number % 40 == 0).withColumn("patient_id", F.lit(None).cast("string"))
    return known.unionByName(other).unionByName(nameless)


def feed_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Claims as the text of a feed, with amounts and dates that cannot be read."""
    number = F.col("claim_id").cast("long")
    amount = F.col("paid_amount").cast("string")
    day = F.date_format("service_date", "yyyy-MM-dd")
    return claims(spark, folder).withColumns(
        {
            "paid_amount": F.when(number % 31 == 5, F.concat(F.lit("USD "), amount)).otherwise(amount),
            "allowed_amount": F.col("allowed_amount").cast("string"),
            "service_date": F.when(number % 37 == 3, F.concat(F.lit("on "), day)).otherwise(day),
        }
    )


def encounters(spark: SparkSession, folder: str) -> DataFrame:
    """One encounter per event."""
    event = F.col("event_id")
    return table(spark, folder, "events").select(
        _text(event).alias("encounter_id"),
        _text("user_id").alias("patient_id"),
        _text(event % 97).alias("provider_id"),
        F.col("ts").cast("date").alias("encounter_date"),
        F.col("event_type").alias("diagnosis_code"),
        F.when(event % 4 != 0, F.col("props")).alias("procedure_code"),
    )


def encounters_over_years(spark: SparkSession, folder: str) -> DataFrame:
    """All encounters, dealt over the years of the claims."""
    days = (F.col("encounter_id").cast("long") * 37 % 2500).cast("int")
    return encounters(spark, folder).withColumn("encounter_date", F.date_add(F.lit("1992-01-01").cast("date"), days))


def encounters_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Encounters of which some lack their patient."""
    known = F.col("encounter_id").cast("long") % 30 != 0
    return encounters(spark, folder).withColumn("patient_id", F.when(known, F.col("patient_id")))


def repeated_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines; (l_orderkey, l_linenumber) repeats."""
    return table(spark, folder, "lineitem")
