"""What the operators share on texts: fixed patterns, lower-casing, and small Arrow slices in Python tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

# What separates words, and what is a word.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole(text: str | Column) -> Column:
    """The text, NULL as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are. Text that is all ASCII takes the faster function."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows a classifier must not learn from: crc32 of the id's text leaves 2 modulo 4. No id: learnt from by nobody."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def in_slices(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of some ``most`` bytes of text (one row at least), so that few texts are Python objects at once."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = filled = 0
        for i, size in enumerate(sizes):
            if i > start and (filled + size > most or i - start >= 512):
                yield batch.slice(start, i - start)
                start, filled = i, 0
            filled += size
        if start < len(sizes):
            yield batch.slice(start)
