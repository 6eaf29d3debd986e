"""Exact dedup: a stream of documents against disk-backed keyed state that never expires.

The stream keeps one entry per digest of the text: how many rows have it, the row that stays (largest doc_id) and
where its content lies (file and row). The state is held by RocksDB, on disk and checkpointed to shared storage; no
watermark, so nothing is forgotten, and a later run on the same checkpoint goes on where this one ended. Copies
combine before they reach the state, so a group of any size costs a row per task.

Digests that were hit more than once are then checked on the full bytes: their rows, and no others, are read again by
the locators of file and row (see ``places``), and if texts behind one digest differ, its rows are grouped by the texts themselves.

Defined results: NULL counts as an empty text. A row without doc_id stays only if no copy of it has one. Of repeated rows
(same doc_id and text) one stays, that of the last file and row. Texts of any length are hashed and compared whole. An empty
table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clinflow.llm.places import FILE, MARKED, ROW, by_mark, with_place
from clinflow.llm.text import whole
from clinflow.scratch import materialize, new_path

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class ExactSettings:
    """``bytes_per_batch``: input of one micro-batch; ``mark_bytes``: bits of the hit rows that are broadcast at once."""

    bytes_per_batch: int = 64 << 30
    mark_bytes: int = 64 << 20


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def located(rows: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, text, digest, file, row) of a parquet source, batch or stream."""
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    return rows.select("doc_id", whole("text").alias("text"), *place).withColumn("digest", digest(F.col("text")))


def update_state(spark: SparkSession, path: str, checkpoint: str, settings: ExactSettings, digest: Callable[[Column], Column]) -> None:
    """Feed all files of ``path`` that the checkpoint has not seen to the keyed state, and end."""
    path = path.rstrip("/")
    session = spark.newSession()  # the state's settings do not touch the caller's session
    session.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    # Else every state partition reserves megabytes of disk before it holds a row.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    files = session.readStream.schema(spark.read.parquet(path).schema).option("maxBytesPerTrigger", str(settings.bytes_per_batch))
    # A pattern that matches the path alone: a stream takes a folder or a pattern, but not a single file.
    rows = located(files.parquet(f"{path[:-1]}[{path[-1]}]"), digest).select("digest", F.struct("doc_id", "file", "row").alias("at"))
    groups = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("at").alias("stays"))
    sink = groups.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
    query = sink.trigger(availableNow=True).start()
    query.awaitTermination()


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(digest, group_size, stays) as the state holds them."""
    state = spark.read.format("statestore").load(checkpoint)
    names = state.schema["value"].dataType.names
    values = [F.col("value")[name] for name in names]
    return state.select(F.col("key")[state.schema["key"].dataType.names[0]].alias("digest"), values[0].alias("group_size"), values[1].alias("stays"))


def colliding(texts: DataFrame, found: DataFrame, settings: ExactSettings, digest: Callable[[Column], Column]) -> DataFrame:
    """Digests behind which the bytes of texts differ. Only texts that were hit travel, equal ones combined."""
    hits = found.filter(F.col("group_size") > 1).select(F.xxhash64("at.file").alias(FILE), F.col("at.row").alias(ROW))

    def ends(rows: DataFrame) -> DataFrame:
        again = rows.filter(MARKED).select("text").withColumn("digest", digest(F.col("text")))
        return again.groupBy("digest").agg(F.min("text").alias("least"), F.max("text").alias("greatest"))

    per_group = by_mark(with_place(texts), hits, ends, settings.mark_bytes)
    both = per_group.groupBy("digest").agg(F.min("least").alias("least"), F.max("greatest").alias("greatest"))
    return both.filter(F.col("least") != F.col("greatest")).select("digest")


def exact_duplicates(spark: SparkSession, path: str, settings: ExactSettings = ExactSettings(), digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of the parquet table at ``path``."""
    checkpoint = new_path(spark, "exact-state")
    update_state(spark, path, checkpoint, settings, digest)
    table = spark.read.parquet(path)
    rows = located(table, digest)
    if not _has_state(spark, path):
        groups = rows.select("digest", F.lit(0).cast("long").alias("group_size"), F.struct("doc_id", "file", "row").alias("stays")).limit(0)
    else:
        groups = materialize(read_state(spark, checkpoint), "groups")
    at = F.struct("doc_id", "file", "row")
    narrow = rows.select("doc_id", at.alias("at"), "digest", F.sha2("text", 256).alias("text_sha256"))
    # Stored: where the hit rows lie is read from it, and the result.
    found = materialize(narrow.join(groups, "digest"), "located")
    bad = materialize(colliding(table.select(whole("text").alias("text")), found, settings, digest), "colliding")
    if not bad.isEmpty():
        found = found.join(bad, "digest", "left_anti")
        apart = rows.join(bad, "digest", "left_semi").withColumn("at", at)
        by_text = apart.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("group_size"), F.max("at").alias("stays"))
        named = apart.join(by_text, ["digest", "text"]).withColumn("text_sha256", F.sha2("text", 256))
        found = found.unionByName(named.select(*found.columns))
    kept = (F.col("at.file") == F.col("stays.file")) & (F.col("at.row") == F.col("stays.row"))
    return found.select("doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256")


def _has_state(spark: SparkSession, path: str) -> bool:
    return not spark.read.parquet(path).select("doc_id").isEmpty()
