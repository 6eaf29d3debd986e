"""Filter interaction audit: what each filter removes at each step of every order of the filters, by packed counters.

A document is a mask: one bit per filter it fails. Documents are counted by part, mask and label; copies of a text
and documents of one mask combine before they travel. Each mask has one big integer whose fields say what becomes of
a document with that mask at every step of every order (removed, kept, redundant, failing nothing else). Per part, the
integers of the masks are summed as often as there are documents. A field is as wide as the number of the part's documents
needs, so no sum runs over into the next field, and the sum unpacks into all counts at once. Good and toxic documents have
sums of their own.

A text fails E if a lesser doc_id has the same text. That is found without moving texts: rows are counted by digest
(256 bits), mask, part, label and doc_id, then by all of these but doc_id with the number of rows at the least doc_id, and
only these narrow counts meet the least doc_id of their digest.

Defined results: a NULL text is empty and fails A alone (and E, as a copy). A NULL source is the part "". Rows
without doc_id have no label; they fail E never, as no id is smaller than theirs, and make nothing else fail it. Repeated rows of one
doc_id are documents each and no copies of one another. Texts of any length are read whole. A document is good, or toxic, if any of its
rows in ``labels`` says so. An empty table has no parts and gives an empty result. Extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from clinflow.llm.text import WORD, count_words, whole
from clinflow.scratch import materialize

# What a field counts, in the order in which the fields of a step stand.
OUTCOMES = ("kept", "removed", "redundant", "unique_fails")
COPY = "E"
# When a document fails each filter.
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITALS_PERCENT = 2
SYMBOLS = "[#$%&*|]"


def text_filters(text: str | Column = "text") -> dict[str, Column]:
    """Filter -> whether the text fails it; words are case-sensitive."""
    text = whole(text)
    words = count_words(text)
    distinct = F.size(F.array_distinct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))))
    return {
        "A": words < LEAST_WORDS,
        "B": distinct * 100 < words * DISTINCT_PERCENT,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.char_length(text) * CAPITALS_PERCENT,
        "D": text.rlike(SYMBOLS),
    }


def _mask(filters: dict[str, Column]) -> Column:
    return sum((F.when(fails, 1 << bit).otherwise(0) for bit, fails in enumerate(filters.values())), F.lit(0)).cast("int")


def failure_counts(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, str]:
    """(part, mask, good, toxic, documents), and the filters that the bits of the mask stand for."""
    filters = text_filters()
    digest = F.unhex(F.sha2(whole("text"), 256))
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), digest.alias("digest"), _mask(filters).alias("mask"))
    # Rows that are alike combine before they travel; a hot part or digest is spread by doc_id.
    rows = materialize(rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n")), "audit-rows")

    marked = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id"))
    marked = marked.agg((F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic"))
    marked = marked.filter(F.coalesce("good", F.lit(False)) | F.coalesce("toxic", F.lit(False)))
    named = rows.filter(F.col("doc_id").isNotNull()).join(marked, F.col("doc_id") == F.col("__id"), "left").drop("__id")
    nameless = rows.filter(F.col("doc_id").isNull()).withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    labelled = named.unionByName(nameless).withColumns({name: F.coalesce(name, F.lit(False)) for name in ("good", "toxic")})

    # Rows of one doc_id that differ in nothing are one row by now, but a doc_id may be in several parts.
    same = ["digest", "part", "mask", "good", "toxic"]
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first")
    counts = labelled.groupBy(*same).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))).alias("nameless"), first)
    counts = materialize(counts, "audit-counts")
    least = counts.groupBy("digest").agg(F.min("first.doc_id").alias("least"), F.count(F.lit(1)).alias("places"))
    # A digest in one place has its least doc_id there; only the others have to ask. Stored, so that a digest of
    # very many parts has a shuffle of its own, in which its rows can be split.
    several = materialize(least.filter(F.col("places") > 1).select("digest", "least"), "audit-least")
    met = counts.join(several, "digest", "left")
    at_least = F.when(F.col("least").isNull() | (F.col("first.doc_id") == F.col("least")), F.col("first.n")).otherwise(0)
    met = met.withColumn("fresh", F.coalesce(at_least, F.lit(0)) + F.coalesce("nameless", F.lit(0)))
    copy = 1 << len(filters)
    either = F.array(F.struct("mask", F.col("fresh").alias("n")), F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - F.col("fresh")).alias("n")))
    each = met.select("part", "good", "toxic", F.explode(either).alias("of")).filter(F.col("of.n") > 0)
    found = each.groupBy("part", F.col("of.mask").alias("mask"), "good", "toxic").agg(F.sum("of.n").alias("documents"))
    return found, "".join(filters) + COPY


def outcomes(mask: int, orders: Sequence[Sequence[int]]) -> list[int]:
    """0 or 1 per order, step and outcome: what becomes of a document that fails the filters of ``mask``."""
    fields = []
    for order in orders:
        gone = False
        for bit in order:
            fails = mask >> bit & 1
            removed = fails and not gone
            redundant = fails and gone
            gone = gone or bool(fails)
            fields += [int(not gone), int(removed), int(redundant), int(mask == 1 << bit)]
    return fields


def packed(fields: Sequence[int], width: int) -> int:
    """A big integer of fields of ``width`` bytes."""
    wide = np.zeros((len(fields), width), np.uint8)
    wide[:, 0] = fields
    return int.from_bytes(wide.tobytes(), "little")


def unpacked(total: int, count: int, width: int) -> np.ndarray:
    wide = np.zeros((count, 8), np.uint8)
    wide[:, :width] = np.frombuffer(total.to_bytes(count * width, "little"), np.uint8).reshape(count, width)
    return wide.view("<u8").astype(np.int64).ravel()


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step.

    ``labels``: (doc_id, quality, toxic). ``shapley`` sums what the step's filter removes, at whichever step, over all orders.
    """
    counts, names = failure_counts(docs, labels)
    orders = list(permutations(range(len(names))))
    steps = factorial(len(names)) * len(names)
    texts = ["".join(names[bit] for bit in order) for order in orders for _ in order]
    at = [step + 1 for _ in orders for step in range(len(names))]
    filters = np.array([bit for order in orders for bit in order])
    longs = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def summed(rows: pd.DataFrame) -> pd.DataFrame:
        # At most one row per mask and label. No field of a sum exceeds the number of documents.
        width = max(1, -(-int(rows["documents"].sum()).bit_length() // 8))
        masks = {mask: packed(outcomes(mask, orders), width) for mask in set(rows["mask"].tolist())}

        def total(some: pd.DataFrame) -> np.ndarray:
            number = sum(masks[mask] * n for mask, n in zip(some["mask"].tolist(), some["documents"].tolist()))
            return unpacked(number, steps * len(OUTCOMES), width).reshape(steps, len(OUTCOMES))

        out = pd.DataFrame(total(rows), columns=list(OUTCOMES))
        removed = OUTCOMES.index("removed")
        out["good_lost"] = total(rows[rows["good"]])[:, removed]
        out["toxic_lost"] = total(rows[rows["toxic"]])[:, removed]
        by_filter = [int(out["removed"].to_numpy()[filters == bit].sum()) for bit in range(len(names))]
        out["shapley"] = np.array(by_filter, np.int64)[filters]
        out.insert(0, "step", np.array(at, np.int32))
        out.insert(0, "filter_order", texts)
        out.insert(0, "part", rows["part"].iloc[0])
        return out

    schema = f"part string, filter_order string, step int, {', '.join(f'{name} long' for name in longs)}"
    return counts.groupBy("part").applyInPandas(summed, schema)
