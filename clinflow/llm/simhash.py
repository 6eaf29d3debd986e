"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked within a few bits through BK-trees.

Equal fingerprints collapse first. The rest is dealt to shards so that any two fingerprints within the radius meet in
at least one: the 64 bits are cut into blocks, two bits can spoil two blocks only, so some choice of the
others agrees. A shard holds a bounded number of fingerprints; one task builds its BK-tree, in which a child hangs
below its parent by their Hamming distance, and asks it for every fingerprint of the shard, following only edges
whose distance differs from that of the parent by the radius at most. Keys that very many fingerprints share are cut
finer, level by level; at the last level a shard is small by construction. A shard reports which fingerprints its
links connect, not the links, so a group of n costs n rows. Components over all shards then follow from those rows.

Shard trees reach the tasks that ask them through the shuffle instead of a broadcast from the driver, since the
fingerprints of all documents may not pass through the driver.

Defined results: a NULL or empty text has fingerprint zero, like any text without words, and links like any other.
Rows without doc_id take part, but name no component: its id is the least doc_id there is in it, NULL if there is none.
Repeated rows are rows of the same component. Texts of any length are hashed whole, in blocks of words. An empty table gives
an empty result. Of extra columns none is read; ``keep_one_of_each`` passes them through.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import combinations
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from clinflow.llm.components import connected_components
from clinflow.llm.places import FILE, MARKED, PLACE, ROW, by_mark, with_place
from clinflow.llm.text import in_slices
from clinflow.scratch import materialize

BITS = 64
SEED = 42
# Words whose shingles are hashed and counted at once.
_BLOCK = 50_000
# (number of blocks) per level; all but two of them must agree.
_LEVELS = (3, 5, 8, 16)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of the shingles: a bit is set if over half of their hashes have it; no words give zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    set_bits = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, n, _BLOCK):
        part = words[start : min(start + _BLOCK, n) + shingle - 1]
        grams = zip(*[part[i:] for i in range(shingle)]) if len(words) >= shingle else [words]
        hashes = np.array([digest(b" ".join(g), SEED) for g in grams], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * set_bits > n).tolist())


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprints(docs: DataFrame, shingle: int = 3, carried: Sequence[str] = ()) -> DataFrame:
    """(doc_id, carried columns, fp) of every row, fp being the fingerprint as a long."""
    names = ["doc_id", *carried]

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = [signed(fingerprint(text, shingle)) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(found, pa.int64())], [*names, "fp"])

    types = ", ".join(f"`{name}` {docs.schema[name].dataType.simpleString()}" for name in names)
    return docs.select(*names, "text").mapInArrow(hashed, f"{types}, fp long")


class BKTree:
    """Values below a root by their Hamming distance to it, each child again a tree."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def near(self, value: int, radius: int) -> list[int]:
        """All values within the radius; only edges that may lead to one are followed."""
        found: list[int] = []
        todo = [self.root] if self.root else []
        while todo:
            other, children = todo.pop()
            distance = (value ^ other).bit_count()
            if distance <= radius:
                found.append(other)
            for step in range(max(distance - radius, 1), distance + radius + 1):
                if step in children:
                    todo.append(children[step])
        return found

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while distance := (value ^ node[0]).bit_count():
            if distance not in node[1]:
                node[1][distance] = (value, {})
                return
            node = node[1][distance]


def linked(values: Iterable[int], radius: int) -> Iterator[tuple[int, int]]:
    """(value, least value linked to it, directly or not) of every distinct value that is linked to a lesser one."""
    mask = (1 << BITS) - 1
    tree, leader = BKTree(), {}

    def top(value: int) -> int:
        while leader[value] != value:
            leader[value] = leader[leader[value]]
            value = leader[value]
        return value

    for value in sorted(set(values)):
        leader[value] = value
        for other in tree.near(value & mask, radius):
            a, b = sorted((top(value), top(signed(other))))
            leader[b] = a
        tree.add(value & mask)
    for value in leader:
        if (least := top(value)) != value:
            yield value, least


def _block_masks(blocks: int, radius: int) -> list[int]:
    """Masks of every choice of ``blocks - radius`` of the blocks of bits."""
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [sum(1 << bit for bit in range(a, b)) for a, b in zip(cuts, cuts[1:])]
    return [signed(sum(chosen)) for chosen in combinations(masks, blocks - radius)]


def _keyed(distinct: DataFrame, blocks: int, radius: int) -> DataFrame:
    """(fp, key): one key per choice of blocks. Equal keys by chance only make a shard larger."""

    def key(i: int, mask: int) -> Column:
        return F.xxhash64(F.lit(blocks), F.lit(i), F.col("fp").bitwiseAND(F.lit(mask)))

    keys = [key(i, mask) for i, mask in enumerate(_block_masks(blocks, radius))]
    return distinct.select("fp", F.explode(F.array(*keys)).alias("key"))


def shards(distinct: DataFrame, radius: int, most: int) -> list[DataFrame]:
    """(fp, shard) frames in which any two fingerprints within the radius share a shard of the same frame."""
    frames = []
    rest = distinct
    for level, blocks in enumerate(_LEVELS):
        blocks += radius - 2  # the levels are meant for two bits; each bit more needs a block more
        keyed = _keyed(rest, blocks, radius)
        rows = rest.count() * len(_block_masks(blocks, radius))
        if not rows:
            break
        heavy = None
        if level + 1 < len(_LEVELS):
            heavy = materialize(keyed.groupBy("key").count().filter(F.col("count") > most).select("key"), "heavy")
            if heavy.isEmpty():
                heavy = None
        light = keyed.join(heavy, "key", "left_anti") if heavy is not None else keyed
        shard = F.pmod("key", F.lit(ceil(rows / most)))
        frames.append(light.select("fp", (shard * len(_LEVELS) + level).alias("shard")))
        if heavy is None:
            break
        rest = materialize(keyed.join(heavy, "key", "left_semi").select("fp").distinct(), "refined")
    return frames


def link_edges(distinct: DataFrame, radius: int = 2, most: int = 2048) -> DataFrame:
    """Edges ``u, v`` that connect exactly the fingerprints which links within the radius connect."""

    def edges(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(linked(rows["fp"].tolist(), radius), columns=["u", "v"], dtype="int64")

    found = [frame.groupBy("shard").applyInPandas(edges, "u long, v long") for frame in shards(distinct, radius, most)]
    out = distinct.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    for frame in found:
        out = out.union(frame)
    return out


def grouped_rows(docs: DataFrame, shingle: int, radius: int, most: int, carried: Sequence[str] = ()) -> DataFrame:
    """(doc_id, carried columns, fp, label, component_id) of every row; ``label`` is the least fingerprint of the component."""
    prints = materialize(fingerprints(docs, shingle, carried), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fp")
    labels = materialize(connected_components(link_edges(distinct.select("fp"), radius, most)), "labels")
    named = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    grouped = named.filter(F.col("label").isNotNull())
    least = grouped.groupBy("label").agg(F.min("least").alias("component_id"))
    of_group = grouped.join(least, "label").select("fp", "label", "component_id")
    alone = named.filter(F.col("label").isNull()).select("fp", F.col("fp").alias("label"), F.col("least").alias("component_id"))
    return prints.join(alone.unionByName(of_group), "fp", "left").select("doc_id", *carried, "fp", "label", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, most: int = 2048) -> DataFrame:
    """(doc_id, fp, component_id) of every row; ``most`` is the number of fingerprints a shard aims at."""
    return grouped_rows(docs, shingle, radius, most).select("doc_id", "fp", "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 2, most: int = 2048, mark_bytes: int = 64 << 20) -> DataFrame:
    """One row of ``docs`` per component: that of least doc_id, rows without one last.

    Of rows that share this doc_id the one of least fingerprint stays, and of those the first of the table. Kept rows are
    found by their place, so no text moves.
    """
    placed = with_place(docs)
    rows = grouped_rows(placed, shingle, radius, most, PLACE)
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "fp", *PLACE)
    stays = rows.groupBy("label").agg(F.min(order).alias("stays")).select(f"stays.{FILE}", f"stays.{ROW}")
    return by_mark(placed, stays, lambda found: found.filter(MARKED).drop(*PLACE, MARKED), mark_bytes)
