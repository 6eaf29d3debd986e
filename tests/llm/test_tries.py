"""The conversation trie against a plain one."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import pytest
import xxhash
from conftest import bag
from fixtures import FOLDER, LONG, WORD, given, imports  # noqa: F401

from clinflow.llm import queries, tries

SCHEMA = "conv_id long, turn long, role string, text string, depth string, a string, words string"


def key(role, text, *seed):
    """The first half of a turn's id, by which turns of equal number stand."""
    h = 42
    for value in (role or "", text or ""):
        h = xxhash.xxh64_intdigest(value.encode(), h)
    return h - (1 << 64) if h >> 63 else h


def rebuilt(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, key(role, text), role or "", text or ""))
    lists = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in lists.items():
        h = crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = lists.get(base, [])[:h] + turns[h:]
    return out


def expected(sequences):
    nodes = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children = Counter(path[:-1] for path in nodes if path)
    leaves, saved = Counter(), Counter()
    for path, members in nodes.items():
        own = (len(members) - 1) * (len(WORD.findall(path[-1][1])) if path else 0)
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += own
    found = Counter()
    for path, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(sequences[c]) == len(path))))
        parent = min(nodes[path[:-1]]) if path else None
        found[min(members), len(path), parent, len(members), children[path], leaves[path], saved[path], sha256(ends.encode()).hexdigest()] += 1
    return found


def rows_of(conversations):
    return [(c, i, role, text, "x", "x", "x") for c, turns in conversations.items() for i, (role, text) in enumerate(turns)]


AWKWARD = [
    *rows_of({c: [("user", "same start"), ("assistant", "same answer"), ("user", f"end {c % 3}")] for c in range(100, 140)}),
    *rows_of({c: [("user", "alone")] for c in (1, 2, 3, 21, 22, 23, 24)}),  # some end without any turn
    (50, None, "user", "before all"), (50, 3, None, None), (50, 3, "", "tie"), (50, 3, "user", "tie"), (50, -1, "user", "minus"),
    (51, 1, "user", "said twice"), (51, 1, "user", "said twice"),
    (60, 0, "user", LONG), (61, 0, "user", LONG + " more"),
    (-5, 0, "user", "negative"), (-20, 0, "user", "negative base"), (0, 0, "user", "zero"),
    (None, 0, "user", "nobody"), (None, None, None, None),
    (70, 0, "ab", "c"), (80, 0, "a", "bc"), (90, 0, "système", "é è"),
]
AWKWARD = [(*row, *["x"] * (7 - len(row))) for row in AWKWARD]


def built(spark, rows, **settings):
    given_rows = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return Counter(map(tuple, tries.conversation_trie(given_rows, tries.TrieSettings(**settings)).collect()))


@pytest.mark.parametrize("container", [1, 5, 40, 16_384])
def test_awkward_rows(spark, container):
    """Bursting down to the last turn, a few levels, and not at all."""
    assert built(spark, AWKWARD, container=container) == expected(rebuilt(AWKWARD))


@pytest.mark.parametrize("container, most_heads", [(30, 65_536), (300, 65_536), (30, 8)])
def test_random_conversations(spark, container, most_heads):
    draw = random.Random(container)
    some = {c: [(draw.choice("ua"), draw.choice(["x", "x", "y z", "w w w"])) for _ in range(draw.randrange(0, 12))] for c in range(400)}
    some |= {c: [("u", "copy")] * 5 + [("a", "b")] * 3 for c in range(400, 700)}  # many copies
    some |= {c: [("u", f"deep {i}") for i in range(60)] + [("a", str(c))] for c in range(700, 720)}  # a long shared prefix
    rows = rows_of(some)
    assert built(spark, rows, container=container, most_heads=most_heads, chunk=7) == expected(rebuilt(rows))


def test_heads_joined_without_broadcast(spark):
    assert built(spark, AWKWARD, container=5, broadcast_bytes=0) == expected(rebuilt(AWKWARD))


def test_query(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in given(table="conversations")]
    assert Counter(map(tuple, queries.op13_trie(spark, FOLDER).collect())) == expected(rebuilt(rows))


def test_no_conversations(spark):
    assert built(spark, []) == Counter()
    assert built(spark, [(None, 1, "a", "b", "x", "x", "x")]) == Counter()


def test_partitions_do_not_matter(spark):
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    settings = tries.TrieSettings(container=50)
    assert bag(tries.conversation_trie(rows, settings)) == bag(tries.conversation_trie(rows.repartition(11), settings))


def test_containers_of_a_shard_are_bounded(spark):
    """Every container holds no more than its limit, but for a sequence of its own."""
    draw = random.Random(4)
    rows = rows_of({c: [("u", draw.choice("ab")) for _ in range(8)] + [("a", str(c))] for c in range(500)})
    lists = tries.turn_lists(spark.createDataFrame(rows, SCHEMA))
    placed = tries.placed(lists, tries.TrieSettings(container=100)).withColumnRenamed("heads", "h")
    a, b = tries.prefix_key(placed["h"])
    sizes = placed.select(a.alias("a"), b.alias("b"), "turns").groupBy("a", "b").agg({"turns": "count"}).collect()
    assert max(r[2] for r in sizes) * 10 <= 100 + 10 and len(sizes) > 20
