"""Substring dedup: sentences covered by a repeated run of consecutive sentences go, but for its first occurrence.

A text is cut after sentence ends and line breaks; a sentence of more than ``longest`` words counts as several, cut where
its words say so and not where it begins, so that a passage within different sentences is cut alike. From
every sentence a span slides: the shortest run of at least ``least_sentences`` sentences with ``least_words`` words.
Spans are compared by 96 bits of hash of their words over all documents. The first occurrence is that of least
doc_id, then place; every sentence that another occurrence covers is removed.

Keys are counted first, so that of the many spans that occur once only the key travels; then spans of repeated keys
find their first place, again combined before they travel. What is lost is gathered per row, and texts travel only where
they lose something: their rows are found by place (see ``places``), whatever the number of them.

Defined results: a NULL or empty text has no sentences and stays as an empty text. Rows with the same doc_id are one
document: what two of them have at the same place is no repetition. Rows without doc_id are one document after all others.
Texts of any length are cut whole. An empty table gives an empty result. Extra columns are not carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate, islice, pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from clinflow.llm.places import FILE, MARKED, PLACE, ROW, by_mark, with_place
from clinflow.llm.text import in_slices
from clinflow.scratch import materialize

KEY = ["key_a", "key_b"]
_WORD = re.compile(r"\S+")
# A sentence end or line break with all the space behind it; a sentence end without any is none.
_GAP = re.compile(r"[.!?\n]\s*(?<=\s)")


@dataclass(frozen=True)
class SpanSettings:
    """``mark_bytes``: bits of the rows that lose something are broadcast up to this size at once."""

    least_sentences: int = 2
    least_words: int = 20
    longest: int = 8
    mark_bytes: int = 64 << 20


def _turns(words: list[str], window: int) -> list[int]:
    """Where pieces of a long sentence begin: the word of least hash in every ``window`` words, the last of equal ones.

    What a window picks depends on its own words alone, so a passage is cut alike wherever it stands, but for its ends;
    no piece is longer than the window.
    """
    hashes = list(map(crc32, map(str.encode, words)))
    picked = [0]
    at = -1
    for last in range(window - 1, len(words)):
        if at <= last - window:
            part = hashes[last : last - window if last >= window else None : -1]
            at = last - part.index(min(part))
        elif hashes[last] <= hashes[at]:
            at = last
        else:
            continue
        if at:
            picked.append(at)
    return picked


def sentences(text: str, longest: int) -> list[list[str]]:
    """Words of consecutive sentences."""
    return [words for _, _, words in _cut(text, longest, False)]


def count_sentences(text: str, longest: int) -> int:
    found = (text[a:b].split() for a, b in pairwise([0, *_ends(text)]))
    return sum(len(_turns(words, longest)) if len(words) > longest else bool(words) for words in found)


def placed_sentences(text: str, longest: int) -> list[tuple[int, int, list[str]]]:
    """(start, end, words) of the sentences, which cover the text; the space after one belongs to it."""
    return list(_cut(text, longest, True))


def _ends(text: str) -> list[int]:
    """Where sentences end before long ones are cut."""
    return [*(end for gap in _GAP.finditer(text) if (end := gap.end()) < len(text)), len(text)]


def _cut(text: str, longest: int, placed: bool) -> Iterator[tuple[int, int, list[str]]]:
    start = 0
    for end in _ends(text):
        words = text[start:end].split()
        if not words:  # space before the first word
            continue
        if len(words) <= longest:
            yield start, end, words
            start = end
            continue
        turns = [*_turns(words, longest), len(words)]
        places = [start, *(word.start() for word in islice(_WORD.finditer(text, start, end), 1, None)), end] if placed else None
        for a, b in zip(turns, turns[1:]):
            yield (places[a], places[b], words[a:b]) if places else (start, end, words[a:b])
        start = end


def spans(counts: list[int], least_sentences: int, least_words: int) -> Iterator[tuple[int, int]]:
    """(first, last) of the span that starts at each sentence, if the text is long enough for one."""
    last = filled = 0
    for first in range(len(counts)):
        while last < len(counts) and (filled < least_words or last - first < least_sentences):
            filled += counts[last]
            last += 1
        if filled < least_words or last - first < least_sentences:
            return
        yield first, last - 1
        filled -= counts[first]


_DIGEST = np.dtype([(KEY[0], ">i8"), (KEY[1], ">i4"), ("rest", ">i4")])


def span_keys(parts: list[list[str]], found: list[tuple[int, int]]) -> np.ndarray:
    """96 bits of hash of each run of sentences, as a long and an int."""
    words = [" ".join(part).encode() for part in parts]
    ends = [0, *accumulate(len(part) + 1 for part in words)]
    joined = b"\x00".join(words)
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(joined[ends[first] : ends[last + 1] - 1]) for first, last in found]), _DIGEST)


def _own_spans(parts: list[list[str]], settings: SpanSettings) -> list[tuple[int, int]]:
    return list(spans([len(words) for words in parts], settings.least_sentences, settings.least_words))


def span_table(docs: DataFrame, settings: SpanSettings) -> DataFrame:
    """(doc_id, place, first, key_a, key_b) of every span of every text; ``docs`` have places."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            counts, keys = [], [np.empty(0, _DIGEST)]
            for text in batch.column("text").to_pylist():
                parts = sentences(text or "", settings.longest)
                found = _own_spans(parts, settings)
                counts.append(len(found))
                keys.append(span_keys(parts, found))
            digests = np.concatenate(keys)
            # One span starts at each sentence, from the first on.
            firsts = np.concatenate([np.arange(n, dtype=np.int32) for n in counts])
            rows = pa.array(np.repeat(np.arange(len(counts)), counts))
            ids = [batch.column(name).take(rows) for name in ("doc_id", *PLACE)]
            columns = [*ids, pa.array(firsts), pa.array(digests[KEY[0]].astype(np.int64)), pa.array(digests[KEY[1]].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *PLACE, "first", *KEY])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", *PLACE).mapInArrow(cut, f"doc_id {id_type}, {FILE} long, {ROW} long, first int, key_a long, key_b int")


def removed_spans(docs: DataFrame, settings: SpanSettings = SpanSettings()) -> DataFrame:
    """(place, spans): first sentence and key of the spans each row of ``docs``, which have places, loses."""
    table = materialize(span_table(docs, settings), "spans")
    counted = table.groupBy(*KEY).count().filter(F.col("count") > 1)
    repeated = materialize(counted.select(*KEY), "repeated-spans")
    rows = materialize(table.join(repeated, KEY, "left_semi"), "span-rows")
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "first")
    # Stored, so that the join has a shuffle of its own, in which the rows of a hot key can be split.
    least = materialize(rows.groupBy(*KEY).agg(F.min(place).alias("least")), "first-places")
    lost = rows.join(least, KEY).filter(~place.eqNullSafe(F.col("least")))
    return lost.groupBy(*PLACE).agg(F.collect_set(F.struct("first", *KEY)).alias("spans"))


def drop_repeated_spans(docs: DataFrame, settings: SpanSettings = SpanSettings()) -> DataFrame:
    """doc_id, n_sentences, n_removed, removed (character ranges, "start:end" joined by commas) and text, what is left of it."""
    texts = with_place(docs.select("doc_id", "text"))
    lost = materialize(removed_spans(texts, settings), "lost-spans")
    none = F.lit(None).cast(lost.schema["spans"].dataType)

    def taken_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            counts, gone, ranges, texts = [], [], [], []
            for text, runs in zip(batch.column("text").to_pylist(), _listed(batch.column("spans"))):
                lost = set(zip(*(runs[name].tolist() for name in ("first", *KEY)))) if len(runs) else set()
                placed = placed_sentences(text or "", settings.longest) if lost else []
                covered = _covered([words for _, _, words in placed], lost, settings)
                counts.append(len(placed) if lost else count_sentences(text or "", settings.longest))
                gone.append(len(covered))
                ranges.append(",".join(f"{placed[i][0]}:{placed[i][1]}" for i in covered))
                hidden = set(covered)
                texts.append("".join(text[s:e] for i, (s, e, _) in enumerate(placed) if i not in hidden) if covered else text or "")
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(ranges, pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_sentences", "n_removed", "removed", "text"])

    id_type = docs.schema["doc_id"].dataType.simpleString()

    def made(rows: DataFrame) -> DataFrame:
        losing = rows.filter(MARKED).join(lost.hint("shuffle_hash"), list(PLACE)).select("doc_id", "text", "spans")
        others = rows.filter(~F.col(MARKED)).select("doc_id", "text", none.alias("spans"))
        return losing.unionByName(others).mapInArrow(taken_out, f"doc_id {id_type}, n_sentences long, n_removed long, removed string, text string")

    return by_mark(texts, lost.select(*PLACE), made, settings.mark_bytes)


def _listed(column: pa.ListArray) -> Iterator[np.ndarray]:
    """The spans of each row, as records; none where there are none."""
    fields = column.flatten()
    rows = np.empty(len(fields), [("first", "i4"), (KEY[0], "i8"), (KEY[1], "i4")])
    for name in rows.dtype.names:
        rows[name] = fields.field(name).to_numpy(zero_copy_only=False)
    end = 0
    for size in pc.fill_null(pc.list_value_length(column), 0).to_pylist():
        yield rows[end : end + size]
        end += size


def _covered(parts: list[list[str]], lost: set[tuple[int, int, int]], settings: SpanSettings) -> list[int]:
    """Sentences within the spans that this text loses, in order."""
    firsts = {first for first, _, _ in lost}
    some = [span for span in _own_spans(parts, settings) if span[0] in firsts] if lost else []
    keys = span_keys(parts, some)
    covered: list[int] = []
    for (first, last), a, b in zip(some, keys[KEY[0]].tolist(), keys[KEY[1]].tolist()):
        if (first, a, b) in lost:
            covered.extend(range(max(first, covered[-1] + 1 if covered else 0), last + 1))
    return covered
