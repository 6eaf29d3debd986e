"""Packing token sequences: bounded-space online packing with best fit.

A task tokenizes its documents one after the other and keeps at most ``windows`` open. Pieces longer than a window are
cut to full windows at once. What remains goes to the open window it fits best; if it fits none, a new one is
opened, and if all are in use, the fullest is filled up with a first part of the piece and emitted. The windows still open
at the end of a task are leftovers: a bounded number of tokens per task. They are dealt to a few groups of bounded size, each of
which goes through the same packer and is merged into full windows, so that a group pads one window at most.

Defined results: a NULL or empty text is the end token alone. Rows without doc_id are packed, their pieces have no
doc_id. Repeated rows are packed each. An empty table gives an empty result. Extra columns are not carried.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from clinflow.llm.text import in_slices
from clinflow.scratch import materialize

_COUNTER_BITS = 33
_MERGED = 1 << 62
# White space outside ASCII, about which tokenizer libraries may differ.
_RARE = re.compile(r"[^\S \t\n\r\x0b\x0c]|[᠎​⁠﻿]")


@dataclass(frozen=True)
class PackSettings:
    """``leftover_tokens``: how many leftover tokens are merged in one task, about."""

    tokenizer: str
    length: int = 1024
    windows: int = 32
    end: int = 0
    leftover_tokens: int = 4_000_000
    with_ids: bool = True


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], list[int]]:
    """text -> ids as the tokenizer file gives them without special tokens added.

    Byte-level vocabularies whose ids follow the order of the merges run on the faster of the two libraries, which
    gives the same ids; texts with rare white space always take the library the file belongs to.
    """
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    fast = _fast_encoder(path)

    def slow_ids(text: str) -> list[int]:
        return own.encode(text, add_special_tokens=False).ids

    if fast is None:
        return slow_ids
    return lambda text: slow_ids(text) if _RARE.search(text) else fast(text)


def _byte_letters() -> dict[str, int]:
    """The letters in which byte-level vocabularies write bytes: printable ones as they are, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    others = [b for b in range(256) if b not in printable]
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


def _fast_encoder(path: str) -> Callable[[str], list[int]] | None:
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    byte_level = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    if model.get("type") != "BPE" or not byte_level or spec.get("normalizer") or model.get("dropout"):
        return None
    special = {token["content"]: token["id"] for token in spec.get("added_tokens", [])}
    letters = _byte_letters()
    vocabulary = {token: i for token, i in model["vocab"].items() if token not in special}
    merged = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    ids = [vocabulary.get(m.replace(" ", "")) for m in merged]
    if None in ids or ids != sorted(ids) or any(c not in letters for token in vocabulary for c in token):
        return None
    ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}
    known = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: known.encode(text, allowed_special="all")


@dataclass(slots=True)
class Piece:
    """Ids ``start`` and on of one document."""

    doc_id: object
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.ids[:at], self.doc_tokens),
            Piece(self.doc_id, self.start + at, self.ids[at:], self.doc_tokens),
        )


class Packer:
    """At most ``windows`` open windows, each with its pieces and its free space."""

    def __init__(self, length: int, windows: int):
        self.length, self.windows = length, windows
        self.open: list[tuple[int, list[Piece]]] = []  # (free, pieces)

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Place a piece; yields the windows that became full."""
        while len(piece.ids) >= self.length:
            full, piece = piece.cut(self.length)
            yield [full]
        while len(piece.ids):
            need = len(piece.ids)
            fitting = [(free, i) for i, (free, _) in enumerate(self.open) if free >= need]
            if fitting:
                free, i = min(fitting)
                pieces = self.open[i][1]
                pieces.append(piece)
                if free == need:
                    del self.open[i]
                    yield pieces
                else:
                    self.open[i] = (free - need, pieces)
                return
            if len(self.open) < self.windows:
                self.open.append((self.length - need, [piece]))
                return
            i = min(range(len(self.open)), key=lambda j: self.open[j][0])
            free, pieces = self.open.pop(i)
            first, piece = piece.cut(free)
            yield [*pieces, first]

    def merge(self) -> Iterator[list[Piece]]:
        """Pour the open windows together, the fullest first; the last window may stay short."""
        rest = [piece for _, pieces in sorted(self.open, key=lambda w: w[0]) for piece in pieces]
        self.open = []
        window, free = [], self.length
        for piece in rest:
            while len(piece.ids) > free:
                first, piece = piece.cut(free)
                yield [*window, first]
                window, free = [], self.length
            window.append(piece)
            free -= len(piece.ids)
            if not free:
                yield window
                window, free = [], self.length
        if window:
            yield window


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "part"]


class _Rows:
    """Pieces on their way out, as columns."""

    def __init__(self, id_type: pa.DataType, with_ids: bool):
        self.id_type, self.with_ids = id_type, with_ids
        self.rows: list[tuple] = []

    def put(self, pieces: list[Piece], sequence_id: int | None, part: int) -> None:
        offset = 0
        for piece in pieces:
            raw = piece.ids.tobytes()
            kept = raw if self.with_ids or sequence_id is None else None
            self.rows.append((piece.doc_id, piece.start, len(piece.ids), crc32(raw), piece.doc_tokens, sequence_id, offset, kept, part))
            offset += len(piece.ids)

    def take(self) -> pa.RecordBatch:
        types = [self.id_type, *[pa.int64()] * 6, pa.binary(), pa.int64()]
        columns = list(zip(*self.rows)) or [()] * len(_NAMES)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], _NAMES)


def _types(id_type: str) -> str:
    return f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, part long"


def pack(docs: DataFrame, settings: PackSettings) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (little-endian, 32 bits each).

    Without ``with_ids`` the ids themselves are left out (NULL), which keeps the result far smaller than the texts.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(settings.tokenizer)
        packer = Packer(settings.length, settings.windows)
        part = TaskContext.get().partitionId()
        sequence = part << _COUNTER_BITS
        out = None
        for batch in in_slices(batches):
            out = out or _Rows(batch.schema.field("doc_id").type, settings.with_ids)
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*encode(text or ""), settings.end], "<u4")
                for window in packer.add(Piece(doc_id, 0, ids, len(ids))):
                    out.put(window, sequence, part)
                    sequence += 1
            yield out.take()
        if out is not None:
            for _, pieces in packer.open:
                out.put(pieces, None, part)
            yield out.take()

    first = materialize(docs.select("doc_id", "text").mapInArrow(packed, _types(id_type)), "packed")
    left = first.filter(F.col("sequence_id").isNull())
    tokens = left.agg(F.sum("length").alias("n")).first()["n"] or 0
    groups = max(1, ceil(tokens / settings.leftover_tokens))

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        packer = Packer(settings.length, settings.windows)
        group = int(rows["part"].iloc[0]) % groups
        sequence = _MERGED | group << _COUNTER_BITS
        out = _Rows(None, settings.with_ids)
        rows = rows.sort_values(["part", "doc_id", "start", "ids_crc32"], kind="stable")
        windows = []
        for row in rows.itertuples():
            piece = Piece(None if pd.isna(row.doc_id) else row.doc_id, row.start, np.frombuffer(row.ids, "<u4"), row.doc_tokens)
            windows.extend(packer.add(piece))
        windows.extend(packer.merge())
        for i, window in enumerate(windows):
            out.put(window, sequence + i, group)
        return pd.DataFrame(out.rows, columns=_NAMES).astype({"doc_id": object})

    group = (F.col("part") % groups).alias("group")
    rest = left.groupBy(group).applyInPandas(merged, _types(id_type))
    done = first.filter(F.col("sequence_id").isNotNull()).unionByName(rest)
    return done.drop("part")
