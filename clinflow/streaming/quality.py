"""Quality as a stream: files that arrive are split into good and rejected rows, batch by batch.

Every micro-batch owns one folder in the good and one in the quarantine zone and replaces it, so a batch that is run again
after a failure leaves what one run leaves. The watermark of a batch is the greatest event day that earlier batches kept, less the
delay. Each batch notes that day, and which batches kept rows behind the watermark; it goes by the note of the batch
before it, so a repeated batch sees the same one, and of all that was ever kept only open batches are read. Rows before
the watermark are late: they go to quarantine with a reason of their own. Of rows that repeat a key the greatest stays, as in the batch job: a batch compares its
rows with what earlier batches kept from the watermark on, and keeps what is new or greater. No kept row of a key can lie
before the watermark while one behind it comes in, as long as the event day is part of the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from clinflow.operators.quality import apply_rules, normalize_dates, standardize_codes, text_columns, with_types
from clinflow.operators.rows import keep_one
from clinflow.rules import Rule
from clinflow.sinks.tables import write_table

LATE = "late"
BATCH = "batch"
_TEXT = "_text"
_NOTE = f"last date, open array<struct<{BATCH}:bigint,day:date>>"


@dataclass(frozen=True)
class StreamTarget:
    """Where good and rejected rows go, and where the stream keeps its progress."""

    good: str
    quarantine: str
    checkpoint: str

    @property
    def notes(self) -> str:
        return f"{self.checkpoint.rstrip('/')}-days"


@dataclass(frozen=True)
class StreamFeed:
    """What a feed looks like: ``key`` holds the columns on which rows repeat, the event day among them."""

    schema: StructType
    rules: Sequence[Rule]
    key: Sequence[str]
    event_day: str
    reason: str
    codes: Sequence[str] = ()
    delay_days: int = 7

    def __post_init__(self) -> None:
        if self.event_day not in self.key:
            raise ValueError(f"the key must hold the event day {self.event_day}")


@dataclass(frozen=True)
class Note:
    """After a batch: the greatest day kept so far, and the greatest day of each batch that has one behind the watermark."""

    last: date | None = None
    open: tuple[tuple[int, date], ...] = ()

    def after(self, batch: int, greatest: date | None, delay_days: int) -> Note:
        """The note once ``batch`` has kept rows up to the day ``greatest``, if any."""
        if greatest is None:
            return self
        last = max(greatest, self.last or greatest)
        since = last - min(timedelta(delay_days), last - date.min)
        return Note(last, tuple((b, day) for b, day in (*self.open, (batch, greatest)) if day >= since))


def note_before(spark: SparkSession, target: StreamTarget, batch: int) -> Note:
    """What the batch before this one noted; the first has none before it, whatever a failed attempt at it has left."""
    if batch == 0:
        return Note()
    row = spark.read.schema(_NOTE).parquet(f"{target.notes}/{BATCH}={batch - 1}").first()
    return Note(row["last"], tuple((each[BATCH], each["day"]) for each in row["open"]))


def write_batch(rows: DataFrame, batch: int, feed: StreamFeed, target: StreamTarget) -> None:
    """Split one micro-batch and replace its folders."""
    spark = rows.sparkSession
    texts = [name + _TEXT for name in text_columns(rows, feed.schema)]
    tidy = standardize_codes(normalize_dates(with_types(rows, feed.schema, _TEXT), [feed.event_day]), feed.codes)
    good, bad = apply_rules(tidy, feed.rules, feed.reason)
    before = note_before(spark, target, batch)
    if before.last is not None:
        watermark = F.date_sub(F.lit(before.last), feed.delay_days)
        # Days that cannot be read failed their rule; what is left has one.
        is_late = F.col(feed.event_day) < watermark
        late = good.filter(is_late).withColumns({"reason": F.lit(feed.reason), "reasons": F.array(F.lit(LATE))})
        good, bad = good.filter(~is_late), bad.unionByName(late)
    good = keep_one(good.drop(*texts), feed.key)
    if before.open:
        paths = [f"{target.good}/{BATCH}={number}" for number, _ in before.open]
        recent = spark.read.schema(good.schema).parquet(*paths).filter(F.col(feed.event_day) >= watermark)
        good = _greater(good, recent, feed.key)
    kept = Observation()
    write_table(good.observe(kept, F.max(feed.event_day).alias("day")), f"{target.good}/{BATCH}={batch}")
    write_table(bad, f"{target.quarantine}/{BATCH}={batch}")
    note = before.after(batch, kept.get.get("day"), feed.delay_days)
    write_table(spark.createDataFrame([(note.last, list(note.open))], _NOTE).coalesce(1), f"{target.notes}/{BATCH}={batch}")


def _greater(new: DataFrame, kept: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key ``kept`` lacks, or that are the greater of the two."""
    both = new.withColumn("__new", F.lit(True)).unionByName(kept.select(*new.columns).withColumn("__new", F.lit(False)))
    # The flag comes last: of rows that are alike the new one counts as greater, so ask for one that was not there.
    others = [name for name in new.columns if name not in key]
    rank = F.struct(*others, (~F.col("__new")).alias("known"))
    best = both.groupBy(*key).agg(F.max(rank).alias("__best"))
    fresh = best.filter(~F.col("__best.known"))
    return fresh.select(*[F.col(name) if name in key else F.col(f"__best.{name}") for name in new.columns])


def run_stream(spark: SparkSession, source: str, feed: StreamFeed, target: StreamTarget, file_format: str = "parquet") -> None:
    """Take in all files of ``source`` that the checkpoint has not seen, and end; call it again after the next drop."""
    held = spark.read.format(file_format).load(source).schema if file_format == "parquet" else feed.schema
    files = spark.readStream.format(file_format).schema(held).option("maxFilesPerTrigger", 1000).load(source)
    sink = files.writeStream.foreachBatch(lambda rows, batch: write_batch(rows, batch, feed, target))
    sink.option("checkpointLocation", target.checkpoint).trigger(availableNow=True).start().awaitTermination()


def good_rows(spark: SparkSession, feed: StreamFeed, target: StreamTarget) -> DataFrame:
    """The greatest row of each key over all batches."""
    return keep_one(spark.read.parquet(target.good).drop(BATCH), feed.key)


def rejected_rows(spark: SparkSession, target: StreamTarget) -> DataFrame:
    return spark.read.parquet(target.quarantine).drop(BATCH)
