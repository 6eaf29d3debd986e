"""The corpus pipeline: documents without toxic ones, repeated lines and near copies, mixed by source and packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again for the next.
All stages but the last return the columns of documents. At the end the shared folder holds the result alone.

Defined results, for every stage: a NULL text is empty; rows without doc_id and repeated rows take part as rows of their own,
and what ties decide is told in the modules of the operators; texts of any length are read whole; extra columns pass through all
stages but the last; an empty table goes through and stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from clinflow.llm import lines, mixing, packing, simhash, toxicity
from clinflow.llm.queries import tokenizer_path
from clinflow.scratch import job_folder, new_path, remove
from clinflow.sources.feeds import read_table


def _like(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with the number of characters following the text."""
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return df.select(*[F.col(f"`{name}`") for name in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity classifier rejects go. It learns from the labels of ``sf_dir``."""
    labels = read_table(spark, f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them. Every document stays, if need be empty."""
    return _like(lines.drop_repeated_lines(docs, counts=False), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one_of_each(docs, shingle=3, radius=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    labels = read_table(spark, f"{sf_dir}/labels.parquet")
    return mixing.mixed_documents(docs, mixing.label_weights(labels))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of token ids."""
    settings = packing.PackSettings(tokenizer_path(), with_ids=False)
    return packing.pack(docs, settings).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Learnt scores, fingerprints and token ids are beyond SQL: tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. What a stage keeps goes when its result is stored, and that when the next one's is."""
    docs = read_table(spark, f"{sf_dir}/documents.parquet")
    folder = new_path(spark, f"pipeline-{uuid.uuid4().hex[:8]}")
    before = None
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        with job_folder(spark, f"stage-{name}"):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            remove(spark, before)
        docs, before = read_table(spark, path), path
    return docs
