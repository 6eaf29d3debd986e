"""Line dedup: levelled sorted runs of line hashes.

A line's key is the line stripped of spaces and in lower case; keys of enough code points that enough documents
hold lose their lines everywhere but in the document of largest doc_id. Batches of documents arrive by falling
doc_id. Each batch is sorted by key and merge-joined with each run: keys that no run has are new and, with
the batch's largest doc_id as keeper, become a run of their own; for the others the batch only adds to the count. Runs
are tables bucketed by key with one sorted file a bucket, so these joins neither shuffle nor sort a run; when a level
holds ``fan`` runs, they are merged, bucket by bucket, to one run of the next level, which is sorted likewise. DataFrame
functions only.

Keys are compared by 128 bits of hash. Hot keys combine before they travel; what reaches one task is one row per task.
Lines carry the place of their row (see ``places``): only texts that lose a line move, whatever their number.

Defined results: a NULL or empty text is one empty line, and stays as an empty text. Rows with the same doc_id are one
document for counting. Rows without doc_id together are one document, ordered before all others; it keeps a line
only if no other document holds it. Texts of any length are split whole. An empty table gives an empty result. Extra columns
pass through.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clinflow.llm.places import MARKED, PLACE, by_mark, with_place
from clinflow.llm.text import SPACE, ascii_lower, whole
from clinflow.scratch import materialize, new_path, remove

KEY = ["key_a", "key_b"]


@dataclass(frozen=True)
class LineSettings:
    """``batches``: how many batches a whole table is fed in; ``fan``: runs of one level before they are compacted;
    ``mark_bytes``: bits of the rows that lose lines are broadcast up to this size at once."""

    least_length: int = 20
    least_documents: int = 3
    batches: int = 4
    fan: int = 2
    mark_bytes: int = 64 << 20


def split_lines(text: str | Column = "text") -> Column:
    return F.split(whole(text), "\n", -1)


def line_key(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE))


def line_table(docs: DataFrame, least_length: int) -> DataFrame:
    """(doc_id, place, at, key_a, key_b): every line long enough, at its place in the text; ``docs`` have places."""
    keys = F.transform(
        F.split(ascii_lower(whole("text")), "\n", -1),
        lambda line, i: F.struct(i.alias("at"), line_key(line).alias("key")),
    )
    long_enough = F.filter(keys, lambda x: F.char_length(x["key"]) >= least_length)
    # First columns of their own, so that no line carries the text it comes from.
    cut = docs.select("doc_id", *PLACE, long_enough.alias("lines"))
    lines = cut.select("doc_id", *PLACE, F.explode("lines").alias("line"))
    key = F.col("line.key")
    return lines.select("doc_id", *PLACE, "line.at", F.xxhash64(key).alias("key_a"), F.xxhash64(F.lit(1), key).alias("key_b"))


@dataclass
class LineRuns:
    """The runs so far, until they are dropped. A run has (key, documents, keeper), each key once over all runs; ``again``: (key, documents)
    that later batches added to known keys."""

    spark: SparkSession
    fan: int = 2
    first: dict[int, list[DataFrame]] = field(default_factory=dict)
    again: list[DataFrame] = field(default_factory=list)
    tables: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        """A session of their own, in which a bucket is a task from the shuffle to the file, and a file is known to be sorted."""
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.session = self.spark.newSession()
        for name, value in {
            "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": str(self.buckets),
            "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
            "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
        }.items():
            self.session.conf.set(name, value)

    def _run(self, rows: DataFrame, label: str) -> DataFrame:
        """Write rows, which are dealt by key to as many tasks as there are buckets, as one sorted file a bucket."""
        name = f"clinflow_{label}_{uuid.uuid4().hex}"
        path = new_path(self.spark, label)
        rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).saveAsTable(name)
        self.tables[name] = path
        return self.session.table(name)

    def runs(self) -> list[DataFrame]:
        return [run for level in sorted(self.first) for run in self.first[level]]

    def joined(self, lines_path: str, condition: Column) -> DataFrame:
        """A batch of the lines at ``lines_path``, one row per key, merge-joined with every run; ``known`` tells keys of a run."""
        lines = self.session.read.parquet(lines_path).filter(condition)
        document = F.struct(F.col("doc_id"))
        batch = lines.groupBy(*KEY).agg(F.count_distinct(document).alias("documents"), F.max("doc_id").alias("keeper"))
        known = F.lit(False)
        for i, run in enumerate(self.runs()):
            there = run.select(*KEY, F.lit(True).alias(f"in_{i}"))
            batch = batch.join(there.hint("merge"), KEY, "left")
            known = known | F.coalesce(f"in_{i}", F.lit(False))
        return batch.select(*KEY, "documents", "keeper", known.alias("known"))

    def add(self, lines_path: str, condition: Column) -> None:
        """Take in one batch of lines (doc_id, key_a, key_b); documents must come by falling doc_id from batch to batch."""
        batch = self._run(self.joined(lines_path, condition), "batch")
        if self.first:
            self.again.append(batch.filter("known").select(*KEY, "documents"))
        self.first.setdefault(0, []).append(batch.filter("not known").select(*KEY, "documents", "keeper"))
        self._compact()

    def merged(self, one: DataFrame, other: DataFrame) -> DataFrame:
        """Two runs, which share no key, merged bucket by bucket."""
        theirs = other.toDF(*KEY, "documents_2", "keeper_2")
        both = one.hint("merge").join(theirs, KEY, "full")
        return both.select(*KEY, *[F.coalesce(name, f"{name}_2").alias(name) for name in ("documents", "keeper")])

    def _compact(self) -> None:
        level = 0
        while len(self.first.get(level, [])) >= self.fan:
            one, *others = self.first[level]
            for other in others:
                one = self._run(self.merged(one, other), "run")
            self.first[level] = []
            self.first.setdefault(level + 1, []).append(one)
            level += 1

    def repeated(self, least_documents: int) -> DataFrame:
        """(key, keeper) of the keys that enough documents hold."""
        again = None
        if self.again:
            again = reduce(DataFrame.unionByName, self.again).groupBy(*KEY).agg(F.sum("documents").alias("more"))
            again = self._run(again, "again")
        found = []
        for run in self.runs():
            total = F.col("documents")
            if again is not None:
                run, total = run.hint("merge").join(again, KEY, "left"), total + F.coalesce("more", F.lit(0))
            found.append(run.filter(total >= least_documents).select(*KEY, "keeper"))
        return reduce(DataFrame.unionByName, found)

    def drop(self) -> None:
        """Take all runs out of the catalog and the shared folder; what was read from them must have been stored."""
        for name, path in self.tables.items():
            self.spark.sql(f"drop table if exists {name}")
            remove(self.spark, path)
        self.tables.clear()


def _batches(lines: DataFrame, count: int) -> list[Column]:
    """Conditions that cut the documents into batches by falling doc_id; rows without doc_id come last."""
    shares = [i / count for i in range(1, count)]
    cuts = lines.select(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 1000).alias("cuts")).first()["cuts"] if shares else []
    cuts = sorted(set(cuts or []), reverse=True)
    bounds = [None, *cuts, None]
    conditions = []
    for above, below in zip(bounds, bounds[1:]):
        condition = F.lit(True)
        if above is not None:
            condition = condition & (F.col("doc_id") < above)
        if below is not None:
            condition = condition & (F.col("doc_id") >= below)
        elif above is not None:
            condition = condition | F.col("doc_id").isNull()
        conditions.append(condition)
    return conditions


def repeated_lines(docs: DataFrame, settings: LineSettings = LineSettings()) -> DataFrame:
    """(place, dropped): the lines each row of ``docs``, which have places, loses; rows that lose none are absent."""
    spark = docs.sparkSession
    path = new_path(spark, "lines")
    line_table(docs, settings.least_length).write.parquet(path)
    lines = spark.read.parquet(path)
    runs = LineRuns(spark, settings.fan)
    try:
        for condition in _batches(lines, settings.batches):
            runs.add(path, condition)
        kept = new_path(spark, "repeated")
        runs.repeated(settings.least_documents).write.parquet(kept)
    finally:
        runs.drop()
    lost = lines.join(spark.read.parquet(kept), KEY).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return lost.groupBy(*PLACE).agg(F.collect_set("at").alias("__dropped"))


def drop_repeated_lines(docs: DataFrame, settings: LineSettings = LineSettings(), counts: bool = True) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and with ``counts`` n_lines (before) and n_dropped beside it."""
    placed = with_place(docs)
    lost = materialize(repeated_lines(placed, settings), "lost-lines")
    none = F.lit(0).cast("long")
    columns = [F.col(f"`{name}`") for name in docs.columns if name not in ("text", *(["n_lines", "n_dropped"] if counts else []))]

    def made(rows: DataFrame) -> DataFrame:
        whole_text = whole("text").alias("text")
        others = rows.filter(~F.col(MARKED)).select(*columns, whole_text, *([F.size(split_lines()).cast("long").alias("n_lines"), none.alias("n_dropped")] if counts else []))
        losing = rows.filter(MARKED).join(lost.hint("shuffle_hash"), list(PLACE))
        # A column of its own: within a lambda, an expression would split the text again for every line.
        losing = losing.withColumn("__lines", split_lines())
        places = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__dropped"))
        kept = F.array_join(F.transform(places, lambda i: F.get("__lines", i)), "\n").alias("text")
        numbers = [F.size("__lines").cast("long").alias("n_lines"), F.size("__dropped").cast("long").alias("n_dropped")] if counts else []
        return others.unionByName(losing.select(*columns, kept, *numbers))

    names = [*docs.columns, *(name for name in ("n_lines", "n_dropped") if counts and name not in docs.columns)]
    return by_mark(placed, lost.select(*PLACE), made, settings.mark_bytes).select(*[f"`{name}`" for name in names])
