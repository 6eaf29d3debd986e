"""Episodes of care as a stream: session windows over the days of a member, kept as state until the watermark closes them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clinflow.sinks.tables import write_table


def _sessions(rows: DataFrame, by: str, day: str, gap_days: int, delay_days: int) -> DataFrame:
    at = rows.withColumn("__at", F.col(day).cast("timestamp")).withWatermark("__at", f"{delay_days} days")
    # Days that are a whole gap apart still belong together, hence the hour.
    session = F.session_window("__at", F.lit(f"{gap_days * 24 + 1} hours"))
    # Rows without a member are in no episode, but their days tell how far time is: a condition on the day as well
    # is not moved to before the watermark.
    counts = F.when(F.col("__at").isNotNull(), F.col(by).isNotNull())
    found = at.filter(counts).groupBy(by, session.alias("session"))
    out = found.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("encounters"))
    return out.drop("session")


def run_episode_stream(
    spark: SparkSession, source: str, target: str, checkpoint: str, by: str, day: str, gap_days: int, delay_days: int = 7
) -> None:
    """Take in the new files of ``source``; episodes that nothing can prolong any more go to ``target``, a folder per batch.

    An episode is closed once a day more than gap and delay behind it has been seen, of whatever member. A batch that is
    run again replaces its folder. Encounters later than the delay are dropped.
    """
    files = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    closed = _sessions(files, by, day, gap_days, delay_days)
    sink = closed.writeStream.outputMode("append").foreachBatch(lambda rows, batch: write_table(rows, f"{target}/batch={batch}"))
    sink.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
