"""Mixing sources to target weights: weighted sampling without replacement by exponential keys.

Sources share a budget of words by weight; no target exceeds ``most`` times its source, and what is cut off is shared
again by weight. A source is taken in as many complete epochs as its target holds; the rest of the target is filled
in the order of the keys -ln(u) / quality of its documents, where u follows from the doc_id alone, so reruns agree.
Prefix sums say how far that reaches; one more document, the one whose size comes nearest to what is left, closes the gap if
that brings the source nearer to its target.

Prefix sums run in three steps, none of which holds a whole source: rows are dealt to ranges of about equal number by source
and key, from a sample of both, so whatever the weights no range is much larger than another; ranges are summed, and a row adds the
sum of the ranges before its own to its place within the range. Only the table of sources (one row each) is ever in one task.

Defined results: a NULL or empty text has size zero and is taken zero words. A NULL source is a source like any
other, the last. Rows without doc_id share one key and are ordered by their size. Repeated rows are documents of their
own. Texts of any length are counted whole. An empty table, or one without words, gives targets of zero. Extra columns pass
through ``mixed_documents``, each row keeping its own, and are not read otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from clinflow.llm.places import PLACE, with_place
from clinflow.llm.text import count_words
from clinflow.scratch import materialize


@dataclass(frozen=True)
class MixSettings:
    """``share``: words of the mix per word there is; ``range_rows``: rows a prefix-sum range aims at, as long as that makes
    no more than ``most_ranges`` ranges."""

    weights: Sequence[int] = (5, 2, 1)
    most: int = 3
    share: float = 1.0
    range_rows: int = 8_192
    most_ranges: int = 20_000


def uniform(doc_id: str | Column) -> Column:
    """A number in (0, 1) from the id's text: 52 bits of its MD5."""
    digits = F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """(source, source_size, documents, target) from one row per source with its size and number of documents.

    Sharing the excess again and again ends at min(cap, weight * level) for one common level, which is found in one
    pass over the sources in the order in which they reach their caps.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in settings.weights])
    place = (F.row_number().over(by_name) - 1).alias("place")
    ranked = sizes.select("*", place).withColumn("weight", F.get(weights, F.col("place") % len(settings.weights)))
    ranked = ranked.withColumn("cap", F.col("source_size") * settings.most)
    ranked = ranked.withColumn("reach", F.col("cap") / F.col("weight"))
    by_reach = Window.orderBy("reach", "place")
    everything = by_reach.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("cap").over(by_reach.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_reach.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    words = F.sum("source_size").over(everything) * settings.share
    levels = ranked.withColumn("level", (words - before) / rest)
    fits = F.when(F.col("level") <= F.col("reach"), F.struct("reach", "place", "level"))
    levels = levels.withColumn("common", F.min(fits).over(everything)["level"])
    target = F.coalesce(F.least(F.col("cap").cast("double"), F.col("weight") * F.col("common")), F.col("cap").cast("double"))
    return levels.select("source", "source_size", "documents", target.alias("target"))


def mix(rows: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """All ``rows`` (doc_id, source, size, quality and any others) with source_size, target, copies and taken.

    ``rows`` should be stored: they are read several times. ``copies`` says how often the document is in the mix.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    aims = materialize(targets(sizes, settings), "targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    aims = aims.withColumn("epochs", epochs.cast("long")).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    keyed = _with(rows, aims.withColumnRenamed("source", "__source"), ["source"])
    weight = F.greatest(F.coalesce(F.col("quality"), F.lit(1.0)), F.lit(1e-9))
    keyed = keyed.withColumn("key", -F.log(uniform("doc_id")) / weight)
    keyed = in_ranges(keyed, rows.count(), settings)
    sums = keyed.groupBy("source", "range").agg(F.sum("size").alias("sum"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("__source"), F.col("range").alias("__range"), F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("start"))
    placed = _with(keyed, starts, ["source", "range"])
    order = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size", "number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("upto", F.col("start") + F.sum("size").over(order))
    placed = materialize(placed.withColumn("inside", F.col("upto") <= F.col("budget")), "placed")

    # What the prefix leaves open, and the document outside it that fills it best.
    filled = placed.groupBy("source", "budget").agg(F.coalesce(F.sum(F.when(F.col("inside"), F.col("size"))), F.lit(0)).alias("filled"))
    gaps = filled.select(F.col("source").alias("__source"), (F.col("budget") - F.col("filled")).alias("gap"))
    miss = F.abs(F.col("gap") - F.col("size"))
    outside = _with(placed.filter(~F.col("inside") & (F.col("size") > 0)), gaps, ["source"]).filter(miss < F.col("gap"))
    # Ties of rows that are alike in all of these fall to one of them by its number.
    best = outside.groupBy(F.col("source").alias("__source")).agg(F.min(F.struct(miss, "key", "doc_id", "size", "number")).alias("best"))
    chosen = _with(placed.withColumn("number", F.col("number")), best, ["source"], "left")
    extra = F.coalesce(F.col("number") == F.col("best.number"), F.lit(False))
    copies = (F.col("epochs") + F.when(F.col("inside") | extra, 1).otherwise(0)).cast("int")
    out = chosen.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
    return out.select(*rows.columns, "source_size", "target", "copies", "taken")


def in_ranges(keyed: DataFrame, count: int, settings: MixSettings) -> DataFrame:
    """``keyed``, of ``count`` rows, stored with ``range``, which rises with source and key; ranges hold about as many rows each."""
    ranges = min(settings.most_ranges, max(1, -(-count // settings.range_rows)))
    # All that orders rows, so that many equal keys can be parted too.
    dealt = keyed.repartitionByRange(ranges, F.col("source").asc_nulls_last(), "key", "doc_id", "size", "number")
    # Bounds are sampled: a second run could cut elsewhere, so the rows are stored with their range.
    return materialize(dealt.withColumn("range", F.spark_partition_id()), "ranged")


def _with(rows: DataFrame, found: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of which ``found`` has twins named with two underscores, NULLs being equal."""
    condition = F.lit(True)
    for name in on:
        condition = condition & F.col(name).eqNullSafe(F.col("__" + name))
    return rows.join(found, condition, how).drop(*["__" + name for name in on])


def sized_rows(docs: DataFrame, quality: DataFrame | None = None, carried: Sequence[str] = ()) -> DataFrame:
    """(doc_id, source, size, quality, number, carried columns), stored. ``quality``: (doc_id, quality), positive weights; 1 if not given.

    ``number`` tells all rows apart.
    """
    rows = docs.select("doc_id", "source", count_words(F.col("text")).alias("size"), *carried)
    if quality is None:
        rows = rows.withColumn("quality", F.lit(1.0))
    else:
        rows = rows.join(quality.groupBy("doc_id").agg(F.max("quality").alias("quality")), "doc_id", "left")
        rows = rows.withColumn("quality", F.coalesce("quality", F.lit(1.0)))
    return materialize(rows.withColumn("number", F.monotonically_increasing_id()), "sizes")


def label_weights(labels: DataFrame) -> DataFrame:
    """Documents known to be good are twice as likely to come early as unknown ones, bad ones half as likely."""
    weight = F.when(F.max("quality") == 1, 2.0).when(F.max("quality") == 0, 0.5)
    return labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(weight.alias("quality"))


def mixed_documents(docs: DataFrame, quality: DataFrame | None = None, settings: MixSettings = MixSettings()) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``."""
    placed = with_place(docs)
    counted = mix(sized_rows(placed, quality, PLACE), settings).filter(F.col("copies") > 0).select(*PLACE, F.col("copies").alias("__copies"))
    found = placed.join(counted.hint("shuffle_hash"), list(PLACE))
    repeated = found.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return repeated.select(*[F.col(f"`{name}`") for name in docs.columns])
