"""Conversation prefix trie: a burst trie over the turns of conversations, as Spark jobs.

A turn is known by 128 bits of hash of its role and text, so from the second step on no text travels. A conversation
becomes the sequence of its turns; equal sequences collapse to one with the number and least id of its members and the
digest of their ids. The digest is made from ids in sorted order, streamed in chunks, so a group of any size fits.

Sequences start in one container below the root. A container with too many turns bursts: its sequences go to
containers by the next turn id, and the container becomes a trie head. Heads are few (``most_heads`` a depth) and are
found by counting prefixes, a few depths a round. What remains are containers of bounded size; a shard holds many of
them. One task sorts a container's sequences and sweeps over them, with the open path as its stack, which gives every node
below a head. Heads then add up the tops of the containers below them.

Defined results: turns stand in the order of ``turn``, NULL first, turns of equal number in the order of their ids, which is the
same in every run; repeated rows are turns each. A NULL role or text is empty, long texts are read whole. Rows without conv_id belong to
no conversation. An empty table has no members, thus no root, and gives an empty result. Extra columns are not carried.
One conversation's turn ids, 20 bytes a turn, have to fit a task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clinflow.llm.text import count_words, whole
from clinflow.scratch import materialize

ID = 16
NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
_TURN = "struct<a:bigint,b:bigint,words:int>"


@dataclass(frozen=True)
class TrieSettings:
    """``container``: turns beyond which a container bursts, of conversations counted up to ``counted`` turns each, so that
    a few very long ones do not burst; ``most_heads`` bounds the heads of a depth, if need be by larger containers;
    ``chunk``: ids joined at once for a digest; ``broadcast_bytes``: heads are broadcast up to this size."""

    container: int = 16_384
    counted: int = 128
    most_heads: int = 65_536
    chunk: int = 1_000
    broadcast_bytes: int = 32 << 20


def turn_lists(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as (a, b, words)."""
    role, text = whole("role"), whole("text")
    turn = F.struct("turn", F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), role, text).alias("b"), count_words(text).cast("int").alias("words"))
    known = rows.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("at"))
    listed = known.groupBy("conv_id").agg(F.sort_array(F.collect_list("at")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["words"].alias("words"))).alias("turns"))


def with_shared_openings(lists: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation opens with the first h turns of the one whose id is the multiple of ``every`` before its own.

    h is crc32 of the id's text modulo ``most``; a conversation's own first h turns are replaced.
    """
    base = F.col("conv_id") - F.col("conv_id") % every
    openings = lists.filter(F.col("conv_id") % every == 0)
    openings = openings.select(F.col("conv_id").alias("__base"), F.slice("turns", 1, most - 1).alias("__opening"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    found = lists.withColumn("__h", h).withColumn("__at", base).join(openings, F.col("__at") == F.col("__base"), "left")
    none = F.array().cast(f"array<{_TURN}>")
    opening = F.slice(F.coalesce("__opening", none), F.lit(1), F.col("__h"))
    own = F.slice("turns", F.col("__h") + 1, F.greatest(F.size("turns") - F.col("__h"), F.lit(0)))
    return found.select("conv_id", F.concat(opening, own).alias("turns"))


def prefix_key(depth: int | Column) -> list[Column]:
    """128 bits of hash of the first ``depth`` turns."""
    ids = F.transform(F.slice("turns", F.lit(1), F.lit(depth) if isinstance(depth, int) else depth), lambda t: F.struct(t["a"], t["b"]))
    return [F.xxhash64(ids), F.xxhash64(F.lit(1), ids)]


def _keyed(rows: DataFrame) -> DataFrame:
    """With the key of the whole sequence as (a, b)."""
    a, b = prefix_key(F.size("turns"))
    return rows.withColumns({"a": a, "b": b})


def members(rows: DataFrame, chunk: int) -> DataFrame:
    """(conv_id, n, ends): least id, number and SHA-256 of the sorted, comma-joined ids of the rows of each key (a, b)."""

    def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of a key, joined; rows come sorted by key and id."""
        key, ids = None, []
        for batch in batches:
            out: list[tuple] = []
            for a, b, conv_id in zip(*(batch.column(name).to_pylist() for name in ("a", "b", "conv_id"))):
                if key != (a, b) or len(ids) == chunk:
                    if ids:
                        out.append((*key, ids[0], len(ids), ",".join(map(str, ids))))
                    key, ids = (a, b), []
                ids.append(conv_id)
            yield _batch(out, _CHUNKS)
        if ids:
            yield _batch([(*key, ids[0], len(ids), ",".join(map(str, ids)))], _CHUNKS)

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One digest per key, fed chunk by chunk; chunks come sorted by key and first id."""
        key, first, n, digest = None, None, 0, sha256()
        for batch in batches:
            out: list[tuple] = []
            for a, b, conv_id, more, text in zip(*(batch.column(name).to_pylist() for name in _CHUNKS.names)):
                if key != (a, b):
                    if n:
                        out.append((first, n, digest.hexdigest()))
                    key, first, n, digest = (a, b), conv_id, 0, sha256()
                digest.update((b"," if n else b"") + text.encode())
                n += more
            yield _batch(out, _MEMBERS)
        if n:
            yield _batch([(first, n, digest.hexdigest())], _MEMBERS)

    # Ranges cut the ids of a hot key into many tasks; what then meets in one task is a few long texts.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = rows.select("a", "b", "conv_id")
    ranged = narrow.repartitionByRange(parts, "a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    joined = ranged.mapInArrow(chunks, "a long, b long, first long, n long, ids string")
    gathered = joined.repartition(parts, "a", "b").sortWithinPartitions("a", "b", "first")
    return gathered.mapInArrow(digests, "conv_id long, n long, ends string")


_CHUNKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])
_MEMBERS = pa.schema([("conv_id", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(values, field.type) for values, field in zip(columns, schema)], schema=schema)


def placed(sequences: DataFrame, settings: TrieSettings) -> DataFrame:
    """``sequences`` with ``heads``, the number of heads above the container of each: the root and so on downwards."""
    weight = F.least(F.size("turns"), F.lit(settings.counted)) + 1
    size = sequences.agg(F.sum(weight).alias("total"), F.count(F.lit(1)).alias("n")).first()
    total = size["total"] or 0
    limit = max(settings.container, total // settings.most_heads)
    if total <= limit or size["n"] < 2:
        return sequences.withColumn("heads", F.lit(0))
    # The root bursts. Each round counts the prefixes of the next depths, of sequences that are under heads so far.
    start, width, found = 1, 2, []
    open_rows = sequences
    while True:
        depths = F.sequence(F.lit(start), F.least(F.size("turns"), F.lit(start + width - 1)))
        keys = F.transform(depths, lambda d: F.struct(d.alias("depth"), *[k.alias(n) for n, k in zip("ab", prefix_key(d))]))
        long_enough = open_rows.filter(F.size("turns") >= start)
        prefixes = long_enough.select("conv_id", weight.alias("weight"), F.explode(keys).alias("at")).select("conv_id", "weight", "at.*")
        sizes = prefixes.groupBy("depth", "a", "b").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n"))
        # At most total / limit of them a depth: bounded by most_heads, whatever the size of the table. A sequence by
        # itself has nothing to part, so every head has a child.
        heads = materialize(sizes.filter((F.col("weight") > limit) & (F.col("n") > 1)).drop("weight", "n"), "trie-heads")
        if heads.isEmpty():
            break
        under = prefixes.join(F.broadcast(heads), ["depth", "a", "b"], "left_semi")
        deepest = materialize(under.groupBy("conv_id").agg(F.max("depth").alias("depth")), "trie-depths")
        found.append(deepest)
        last = start + width - 1
        open_rows = sequences.join(deepest.filter(F.col("depth") == last).select("conv_id"), "conv_id", "left_semi")
        start, width = last + 1, min(16, 2 * width)
    if not found:
        return sequences.withColumn("heads", F.lit(1))
    depths = found[0]
    for more in found[1:]:
        depths = depths.unionByName(more)
    depths = depths.groupBy("conv_id").agg(F.max("depth").alias("heads"))
    return sequences.join(depths, "conv_id", "left").withColumn("heads", F.coalesce("heads", F.lit(0)) + 1)


def sweep(sequences: list[tuple[bytes, list[int], int, int, str]], top: int) -> tuple[list[list[int | None]], list[str | None]]:
    """Nodes of a container from depth ``top`` on, in the order of NODE, and the digest of those that sequences end at.

    A sequence is (turn ids, words of its turns, least id, members, digest). The first node is the container's top.
    """
    nodes: list[list] = []
    ends: list[str | None] = []
    parents: list[int | None] = []
    words_of: list[int] = []
    path: list[int] = []  # open nodes from the top down

    def close() -> None:
        node = path.pop()
        own = nodes[node]
        own[5] = own[5] or 1
        own[6] += (own[3] - 1) * words_of[node]
        if path:
            above = nodes[path[-1]]
            above[0] = min(above[0], own[0])
            above[3] += own[3]
            above[4] += 1
            above[5] += own[5]
            above[6] += own[6]

    previous = b""
    for ids, words, least, n, digest in sorted(sequences, key=lambda s: s[0]):
        length = len(ids) // ID
        shared = _shared(previous, ids, top)
        while path and top + len(path) - 1 > shared:
            close()
        for depth in range(top + len(path), length + 1):
            parents.append(path[-1] if path else None)
            path.append(len(nodes))
            nodes.append([least, depth, None, 0, 0, 0, 0])
            ends.append(None)
            words_of.append(words[depth - 1] if depth else 0)
        at = nodes[path[-1]]
        at[0] = min(at[0], least)
        at[3] += n
        ends[path[-1]] = digest
        previous = ids
    while path:
        close()
    for node, parent in zip(nodes, parents):
        node[2] = nodes[parent][0] if parent is not None else None
    return nodes, ends


def _shared(a: bytes, b: bytes, known: int) -> int:
    """How many turns two sequences have in common, ``known`` of them for certain."""
    most = min(len(a), len(b)) // ID
    if a[: most * ID] == b[: most * ID]:
        return most
    while a[known * ID : (known + 1) * ID] == b[known * ID : (known + 1) * ID]:
        known += 1
    return known


_SWEPT = pa.schema([*((name, pa.int64()) for name in NODE), ("ends_sha256", pa.string()), ("up", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("words", pa.int32())])))])
_EMPTY = sha256(b"").hexdigest()


def _swept(shard: pa.Table) -> pa.Table:
    """Nodes of all containers of a shard; the top of each carries the heads above it."""
    shard = shard.combine_chunks()
    turns = shard.column("turns").combine_chunks()
    offsets = turns.offsets.to_numpy()
    fields = turns.values
    ids = np.column_stack([fields.field(name).to_numpy() for name in "ab"]).astype(np.int64).tobytes()
    words = fields.field("words").to_numpy()
    containers: dict[tuple, list[int]] = {}
    tops, key_a, key_b, least, members_of, digests = (shard.column(name).to_pylist() for name in ("heads", "key_a", "key_b", "conv_id", "n", "ends"))
    for row, key in enumerate(zip(tops, key_a, key_b)):
        containers.setdefault(key, []).append(row)
    nodes, ends, up_rows, top_at = [], [], [], []
    for (top, _, _), rows in containers.items():
        some = [
            (ids[offsets[r] * ID : offsets[r + 1] * ID], words[offsets[r] : offsets[r + 1]].tolist(), least[r], members_of[r], digests[r]) for r in rows
        ]
        found, found_ends = sweep(some, top)
        top_at.append(len(nodes))
        up_rows.append(rows[0])
        nodes += found
        ends += found_ends
    up: list = [None] * len(nodes)
    for at, heads in zip(top_at, shard.column("up").take(pa.array(up_rows, pa.int64())).to_pylist()):
        up[at] = heads
    columns = [pa.array(values, pa.int64()) for values in zip(*nodes)] or [pa.array([], pa.int64())] * len(NODE)
    return pa.Table.from_arrays([*columns, pa.array([end or _EMPTY for end in ends], pa.string()), pa.array(up, _SWEPT.field("up").type)], schema=_SWEPT)


def trie(sequences: DataFrame, settings: TrieSettings = TrieSettings()) -> DataFrame:
    """Every node of the trie of ``sequences`` (conv_id, turns): the columns of NODE and ends_sha256."""
    stored = materialize(_keyed(sequences), "trie-sequences")
    ends = materialize(members(stored, settings.chunk), "trie-members")
    distinct = materialize(stored.join(ends, "conv_id").select("conv_id", "turns", "n", "ends"), "trie-distinct")
    # The heads above a container, from the root on, with the words of their last turns.
    words = F.when(F.col("__d") > 0, F.get("turns", F.col("__d") - 1)["words"]).otherwise(0)
    head = F.struct(*[k.alias(n) for n, k in zip("ab", prefix_key(F.col("__d")))], words.alias("words"))
    rows = placed(distinct, settings)
    spread = rows.filter("heads > 0").withColumn("__d", F.explode(F.sequence(F.lit(0), F.col("heads") - 1)))
    ups = spread.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("__d", head.alias("head")))).alias("up"))
    ups = ups.select("conv_id", F.transform("up", lambda x: x["head"]).alias("up"))
    none = F.array().cast(f"array<{_TURN}>")
    rows = rows.join(ups, "conv_id", "left").withColumn("up", F.coalesce("up", none))
    a, b = prefix_key(F.col("heads"))
    rows = materialize(rows.withColumns({"key_a": a, "key_b": b, "size": F.size("turns")}), "trie-placed")
    shards = _shard_count(rows, settings)
    inside = rows.filter(F.col("size") >= F.col("heads"))
    shard = F.pmod("key_a", F.lit(shards)).alias("shard")
    held = inside.select(shard, "conv_id", "turns", "n", "ends", "heads", "up", "key_a", "key_b")
    schema = ", ".join(f"{name} long" for name in NODE) + f", ends_sha256 string, up array<{_TURN}>"
    swept = materialize(held.groupBy("shard").applyInArrow(_swept, schema), "trie-nodes")

    below = swept.filter(F.col("up").isNull())
    tops = swept.filter(F.col("up").isNotNull())
    columns = [*NODE, "ends_sha256"]
    if rows.filter(F.col("heads") > 0).isEmpty():
        return below.select(*columns).unionByName(tops.select(*columns))
    stopped = rows.filter(F.col("size") < F.col("heads"))
    heads, linked = _heads(tops, stopped, settings)
    return below.select(*columns).unionByName(linked.select(*columns)).unionByName(heads.select(*columns))


def _shard_count(rows: DataFrame, settings: TrieSettings) -> int:
    total = rows.agg(F.sum(F.least(F.col("size"), F.lit(settings.counted)) + 1).alias("n")).first()["n"] or 0
    return max(1, -(-total // settings.container))


def _heads(tops: DataFrame, stopped: DataFrame, settings: TrieSettings) -> tuple[DataFrame, DataFrame]:
    """(heads, tops with their parents) from the tops of containers and the sequences that end at a head."""
    last = F.element_at("up", -1)
    parts = tops.select("up", "conv_id", "n_convs", "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends"))
    zero = F.lit(0).cast("long")
    parts = parts.unionByName(stopped.select("up", "conv_id", F.col("n").alias("n_convs"), zero.alias("n_leaves"), zero.alias("saved_tokens"), "ends"))
    # Every part adds to all heads above it; combined before it travels.
    each = parts.select("*", F.posexplode("up").alias("depth", "head")).withColumn("ends", F.when(F.col("depth") == F.size("up") - 1, F.col("ends")))
    summed = each.groupBy("depth", F.col("head.a").alias("a"), F.col("head.b").alias("b")).agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("below"),
        F.max("ends").alias("ends"),
        F.max("head.words").alias("words"),
        F.max(F.slice("up", F.lit(1), F.col("depth") + 1)).alias("path"),
    )
    heads = materialize(summed.withColumn("own", (F.col("n_convs") - 1) * F.col("words")), "trie-head-sums")

    def small(df: DataFrame) -> DataFrame:
        """Few rows a head and depth: broadcast while they are small, else met by a join that can split hot keys."""
        return F.broadcast(df) if heads.count() * 64 <= settings.broadcast_bytes else df

    up = heads.select("own", F.posexplode("path").alias("depth", "head"))
    saved = up.groupBy("depth", F.col("head.a").alias("a"), F.col("head.b").alias("b")).agg(F.sum("own").alias("saved"))
    parent = F.get("path", F.size("path") - 2)
    children = tops.select((F.size("up") - 1).alias("depth"), last["a"].alias("a"), last["b"].alias("b"))
    children = children.unionByName(heads.filter("depth > 0").select((F.col("depth") - 1).alias("depth"), parent["a"].alias("a"), parent["b"].alias("b")))
    children = children.groupBy("depth", "a", "b").agg(F.count(F.lit(1)).alias("n_children"))
    above = heads.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    above = materialize(above, "trie-parents")
    whole_heads = heads.join(saved, ["depth", "a", "b"]).join(children, ["depth", "a", "b"])
    whole_heads = whole_heads.withColumns({"pa": parent["a"], "pb": parent["b"]}).join(small(above), ["depth", "pa", "pb"], "left")
    whole_heads = whole_heads.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("below") + F.col("saved")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(_EMPTY)).alias("ends_sha256"),
    )
    asking = tops.drop("parent_conv_id").withColumns({"pa": last["a"], "pb": last["b"]})
    linked = asking.join(small(above), ["depth", "pa", "pb"], "left")
    return whole_heads, linked


def conversation_trie(rows: DataFrame, settings: TrieSettings = TrieSettings()) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text), each opening with the turns it shares."""
    lists = materialize(turn_lists(rows), "turn-lists")
    return trie(with_shared_openings(lists), settings)
