"""The labelled rows classifiers learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clinflow.llm.text import held_out, whole
from clinflow.scratch import materialize


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, y) of at most ``most`` documents whose label is known and that are not held out.

    The documents are those with the least hash of their id, whatever the order of the tables. Labels that
    are NULL do not count; of repeated labels the majority does, a tie being 1. Of repeated documents the
    greatest text counts. Written out, so that the steps of a fit read the same few rows.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    found = docs.select("doc_id", whole("text").alias("text")).join(F.broadcast(chosen), "doc_id")
    return materialize(found.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("y").alias("y")), "labelled")
