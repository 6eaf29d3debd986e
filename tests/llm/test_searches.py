"""Top-k search, mixing, packing, secret scans and the pipeline against plain versions."""

from __future__ import annotations

import heapq
import math
import random
import re
from collections import Counter, defaultdict
from hashlib import sha256
from pathlib import Path
from zlib import crc32

import duckdb
import numpy as np
import pytest
from conftest import bag, plan
from fixtures import AWKWARD, FOLDER, SCHEMA, WORD, frame, given, imports, kept_lines, simhash, groups  # noqa: F401

from pyspark.sql import functions as F

import corpus_pipeline
from clinflow.llm import mixing, packing, queries, secrets, topk, toxicity
from clinflow.scratch import materialize


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in ("documents", "labels", "embeddings", "pages", "conversations"):
        connection.sql(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, oracle, name):
    got = queries.REGISTERED[name](spark, FOLDER).toArrow()
    want = oracle.sql(queries.ORACLES[name]).to_arrow_table()
    assert set(got.column_names) == set(want.column_names)
    columns = sorted(got.column_names)
    rows = [Counter(zip(*[map(repr, t[c].to_pylist()) for c in columns])) for t in (got, want)]
    assert rows[0] == rows[1]


# --- search ---

VECTORS = [(i, [math.sin(i * k + 1) for k in range(4)]) for i in range(240)]
ODD = [(500, None), (501, [1.0, None, 0.0, 0.0]), (502, [math.nan, 0.0, 0.0, 0.0]), (503, [math.inf, 0.0, 0.0, 0.0]), (None, [0.1, 0.2, 0.3, 0.4])]
ODD += [(504, [0.1, 0.2]), (550, [0.3, -0.2]), (505, []), (600, []), (7, [0.5, 0.5, 0.5, 0.5]), (100, [0.25, 0.0, 0.0, 0.0])]
ODD += [(800, [1e200, 1.0, 0.0, 0.0]), (801, [-1e200, 1.0, 0.0, 0.0]), (802, [0.0, 0.0, 0.0, 0.0]), (803, [0.0, 0.0, 0.0, 0.0])]


def best_by_hand(rows, every, k=5):
    fine = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in fine]
    asked = {}
    for i, v in fine:
        if i % every == 0:
            asked[i] = max(asked.get(i, v), v)
    out = set()
    for i, v in asked.items():
        q = [math.floor(256 * float(x)) for x in v]
        held = lambda x: max(-(2**63), min(2**63 - 1, x))
        scores = [(-held(sum(a * b for a, b in zip(q, w))), j) for j, w in whole if j != i and len(w) == len(q)]
        for rank, (score, j) in enumerate(heapq.nsmallest(k, scores), start=1):
            out.add((i, rank, j, -score))
    return out


@pytest.mark.parametrize("settings", [topk.SearchSettings(), topk.SearchSettings(shard=20, block=2, leaf=3)])
def test_search_on_awkward_rows(spark, settings):
    rows = VECTORS + ODD
    got = topk.top_k(spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string"), F.col("vec_id") % 50 == 0, settings)
    assert set(map(tuple, got.collect())) == best_by_hand(rows, 50)


def test_search_with_ties_and_few_rows(spark):
    same = [(i, [0.5, 0.5]) for i in range(30)]
    got = topk.top_k(spark.createDataFrame(same, "vec_id long, embedding array<float>"), F.col("vec_id") % 10 == 0, topk.SearchSettings(shard=4, leaf=2))
    assert set(map(tuple, got.collect())) == best_by_hand(same, 10)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(spark.createDataFrame([(0, [1.0])], empty.schema), F.col("vec_id") % 50 == 0).count() == 0


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    rows = np.concatenate([rng.integers(-20, 20, (300, 8)) + 200 * np.eye(8, dtype=int)[i % 8] for i in range(4)])
    tree = topk.BallTree(rows, 16)
    query = 200 * np.eye(8, dtype=int)[1]
    asked = query[None, :].astype(float)
    bounds = topk.upper_bounds(asked, np.linalg.norm(asked, axis=1), tree.centre, tree.radius)[0]
    for node, members in enumerate(tree.members):
        assert (rows[members] @ query).max() <= bounds[node]
    best = np.sort(rows @ query)[-5]
    assert (bounds < best).sum() > len(bounds) / 2


def share_scored(rows, every):
    queries, ids = rows[::every], np.arange(len(rows))
    found = topk.Best(ids[::every], np.full(len(queries), -(2**63), np.int64), 5)
    scored = topk.BallTree(rows, 64).search(rows, ids, found, queries)
    scores = queries @ rows.T
    scores[np.arange(len(queries)), ids[::every]] = -(2**62)
    assert (np.sort(scores, axis=1)[:, :-6:-1] == found.scores).all()
    return scored / (len(queries) * len(rows))


def test_share_of_vectors_scored(spark):
    """Vectors in groups: most are never scored. The given ones point everywhere alike: all are."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(32, 16)) * 2000
    grouped = (centres[rng.integers(0, 32, 4000)] + rng.normal(size=(4000, 16)) * 40).astype(np.int64)
    assert share_scored(grouped, 50) < 0.25
    vectors = topk.quantised([r["embedding"] for r in given("/root/testdata/sf0.01", "embeddings")], 256)
    assert share_scored(vectors, 50) > 0.9


def test_near_vectors_share_a_shard_and_far_shards_are_not_searched(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 6)) * 30
    rows = [(i, (centres[i % 8] + rng.normal(size=6)).tolist()) for i in range(1600)]
    settings = topk.SearchSettings(shard=100, block=7, leaf=8)
    df = materialize(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "v").withColumn("width", F.size("embedding")).withColumn("number", F.col("vec_id"))
    held, width, others = topk._dealt(df.withColumn("asks", F.col("vec_id") % 40 == 0), settings)
    sizes = [r["count"] for r in held.groupBy("shard").count().collect()]
    assert (width, others) == (6, 0) and 8 <= len(sizes) <= 40 and max(sizes) <= 400
    balls = topk._balls(held, settings)
    asked = held.filter("asks").select("vec_id", "embedding", "width", F.lit(2**40).alias("least"))
    assert topk._sent(asked, balls, settings, False).count() == 0
    got = topk.top_k(df, F.col("vec_id") % 40 == 0, settings)
    assert set(map(tuple, got.collect())) == best_by_hand(rows, 40)


def test_alike_vectors_do_not_fill_one_shard(spark):
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 else [float(i), 1.0, -float(i)]) for i in range(900)]
    df = materialize(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "v").withColumn("width", F.size("embedding")).withColumn("number", F.col("vec_id"))
    held, _, _ = topk._dealt(df, topk.SearchSettings(shard=50))
    assert max(r["count"] for r in held.groupBy("shard").count().collect()) <= 150
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, topk.SearchSettings(shard=50, block=3, leaf=4))
    assert set(map(tuple, got.collect())) == best_by_hand(rows, 50)


# --- mixing ---


def shares_by_hand(sizes, weights=(5, 2, 1), most=3):
    """Share, cut at the cap, share the excess again, until nothing is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, left = {}, sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in fixed]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if weight[s] * level > most * sizes[s]]
        if not over:
            return {**fixed, **{s: weight[s] * level for s in open_}}
        for s in over:
            fixed[s] = most * sizes[s]
            left -= fixed[s]


@pytest.mark.parametrize("range_rows", [2, 50_000])
def test_mixing(spark, range_rows):
    draw = random.Random(4)
    rows = [(i, " ".join(["w"] * draw.randrange(1, 40)), "en", s, 0, *["x"] * 7) for i, s in enumerate(draw.choices(["a", "b", "c", "d", "é", None, "z"], [400, 30, 30, 5, 20, 10, 30], k=600))]
    rows += AWKWARD
    settings = mixing.MixSettings(range_rows=range_rows)
    docs = frame(spark, rows)
    got = mixing.mix(mixing.sized_rows(docs), settings).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    target = shares_by_hand(sizes)
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(r[0]), len(WORD.findall(r[1] or ""))) for r in rows)
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, words in sizes.items():
        longest = max(len(WORD.findall(r[1] or "")) for r in rows if r[3] == source)
        assert abs(taken[source] - target[source]) <= longest
    again = mixing.mix(mixing.sized_rows(docs.repartition(7)), settings).collect()
    columns = ("doc_id", "source", "size", "taken")
    assert Counter(tuple(r[c] for c in columns) for r in got) == Counter(tuple(r[c] for c in columns) for r in again)


def test_ranges_do_not_change_the_mix(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = mixing.sized_rows(docs)
    found = [Counter((r["doc_id"], r["taken"]) for r in mixing.mix(rows, mixing.MixSettings(range_rows=n)).collect()) for n in (3, 50_000)]
    assert found[0] == found[1]


def test_good_documents_come_early(spark):
    """Half of a source is taken, and of the documents with the fourfold weight more than half."""
    rows = [(i, "w w w w", "en", "ab"[i % 2], 0, *["x"] * 7) for i in range(4000)]
    known = spark.createDataFrame([(i, float(i // 2 % 2 * 3 + 1)) for i in range(4000)], "doc_id long, quality double")
    got = mixing.mix(mixing.sized_rows(frame(spark, rows), known), mixing.MixSettings(weights=(1, 3))).filter("source = 'a'").collect()
    good = [r["taken"] > 0 for r in got if r["doc_id"] // 2 % 2]
    bad = [r["taken"] > 0 for r in got if not r["doc_id"] // 2 % 2]
    assert sum(good) > 1.5 * sum(bad) and abs(sum(good) + sum(bad) - 1000) <= 1


def test_mixed_documents_repeat_as_taken(spark):
    docs = frame(spark)
    counts = Counter()
    for r in mixing.mix(mixing.sized_rows(docs)).collect():
        counts[r["doc_id"], r["source"], r["size"]] += r["copies"]
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    assert Counter((r["doc_id"], r["source"], len(WORD.findall(r["text"] or ""))) for r in got.collect()) == +counts
    assert mixing.mixed_documents(frame(spark, [])).count() == 0


def test_rows_alike_but_for_other_columns_stay_apart(spark):
    """Rows of one id, source and text are taken each with its own columns, the same in every run."""
    rows = [(1, "w w w", f"lang{i}", "a", i, *["x"] * 7) for i in range(40)] + [(2, "w " * 900, "en", "b", 0, *["x"] * 7)]
    got = mixing.mixed_documents(frame(spark, rows))
    assert len({r["lang"] for r in got.filter("doc_id = 1").collect()}) == 40


@pytest.mark.parametrize("weight", [0.05, 1.0, 20.0])
def test_ranges_are_even_whatever_the_weight(spark, weight):
    """A hot source, many rows without doc_id (one key), and weights far from one: no range above twice its aim."""
    rows = spark.range(40_000).selectExpr("if(id % 5 = 0, null, id) doc_id", "if(id % 3 = 0, concat('s', id % 50), 'hot') source", "3L size", "id number")
    rows = materialize(rows.withColumn("quality", F.lit(weight)), "rows")
    keyed = rows.withColumn("key", -F.log(mixing.uniform("doc_id")) / F.col("quality"))
    ranged = mixing.in_ranges(keyed, 40_000, mixing.MixSettings(range_rows=1000))
    sizes = [r["count"] for r in ranged.groupBy("range").count().collect()]
    assert max(sizes) <= 2000 and sum(sizes) == 40_000
    bounds = ranged.groupBy("source", "range").agg(F.min("key"), F.max("key")).orderBy("source", "range").collect()
    for one, other in zip(bounds, bounds[1:]):
        assert one[0] != other[0] or one[3] <= other[2]


# --- packing ---


def check_packing(rows, pieces, length=1024):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    want = Counter((d, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])) for d, t in rows)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"], p["doc_tokens"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for sequence in by_sequence.values():
        at = 0
        for p in sorted(sequence, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= length
    for (doc_id, tokens), found in by_doc.items():
        texts = [(ids, n) for (d, ids), n in want.items() if d == doc_id and len(ids) == tokens]
        expected = Counter()
        for p in found:
            fits = [ids for ids, _ in texts if crc32(np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) == p["ids_crc32"]]
            assert fits
        assert sum(p["length"] for p in found) == tokens * sum(n for _, n in texts), expected
    assert {d for d, _ in by_doc} == {d for d, _ in want}
    return [sum(p["length"] for p in s) for s in by_sequence.values()]


@pytest.mark.parametrize("windows, leftover", [(1, 4_000_000), (4, 500), (32, 4_000_000)])
def test_packing_on_awkward_rows(spark, windows, leftover):
    settings = packing.PackSettings(queries.tokenizer_path(), length=64, windows=windows, leftover_tokens=leftover)
    got = packing.pack(frame(spark), settings).collect()
    lengths = check_packing([r[:2] for r in AWKWARD], got, 64)
    groups_ = max(1, math.ceil(3 * windows * 64 / leftover))
    assert sum(n < 64 for n in lengths) <= groups_
    for p in got:
        ids = np.frombuffer(p["ids"], "<u4")
        assert len(ids) == p["length"] and crc32(p["ids"]) == p["ids_crc32"]
        assert (ids[-1] == 0) == (p["start"] + p["length"] == p["doc_tokens"]) or 0 in ids


def test_packing_query(spark):
    got = queries.op9_packing(spark, FOLDER).collect()
    lengths = check_packing([(r["doc_id"], r["text"]) for r in given()], got)
    assert sum(1024 - n for n in lengths) <= 1024


def test_packing_nothing(spark):
    assert packing.pack(frame(spark, []), packing.PackSettings(queries.tokenizer_path())).count() == 0


def test_packer_keeps_few_windows_open():
    packer = packing.Packer(100, 3)
    draw = random.Random(6)
    out = 0
    for i in range(500):
        n = draw.randrange(1, 250)
        for window in packer.add(packing.Piece(i, 0, np.zeros(n, "<u4"), n)):
            assert sum(len(p.ids) for p in window) == 100
            out += 1
        assert len(packer.open) <= 3 and all(free > 0 for free, _ in packer.open)
    assert out > 500


def test_both_tokenizer_routes_agree():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(queries.tokenizer_path())
    encode = packing.encoder(queries.tokenizer_path())
    draw = random.Random(8)
    letters = "aZ é漢字\t\n\r\x0b  '’s'll12٣  \x1c\x85﻿😀<|endoftext|>-_́"
    for _ in range(500):
        text = "".join(draw.choices(letters, k=draw.randrange(30)))
        assert encode(text) == own.encode(text, add_special_tokens=False).ids


# --- secrets ---

ASSIGN = re.compile(r'(password|passwd|secret|token|api_?key)["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)', re.I | re.A)


def base_by_hand(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_patterns(spark):
    rows = AWKWARD + [
        (90, "token=token=token=abcdefgh secret:'x' API_KEY=abcdefghK tOKen=abcdefgh password=" + "a" * 5000, "en", "a", 0, *["x"] * 7),
        (91, "AKIAAKIAAKIAAKIA AKIA" + "f" * 40 + " " + "0" * 31 + "g" + "1" * 32, "en", "a", 0, *["x"] * 7),
    ]
    got = secrets.scan(frame(spark, rows))
    found = Counter((r["doc_id"], tuple((s["start"], s["kind"], s["end"]) for s in r["base"])) for r in got.collect())
    assert found == Counter((r[0], tuple(base_by_hand(r[1] or ""))) for r in rows)
    assert secrets.scan(frame(spark, [])).count() == 0


def test_secrets_run_without_python(spark):
    text = plan(queries.op10_secrets(spark, FOLDER))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_secrets_query(spark):
    got = queries.op10_secrets(spark, FOLDER).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in given()}
    assert len(got) == len(texts)
    for r in got:
        base = base_by_hand(texts[r["doc_id"]])
        listed = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == sha256(listed.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))


def normal_above(z):
    return 1 / (1 + math.exp(max(min(1.5976 * z + 0.070566 * z**3, 700), -700)))


def randomness_by_hand(token):
    letters = next(a for a in secrets.ALPHABETS.values() if not set(token) - set(a))
    places, size, n = [letters.index(c) for c in token], len(letters), len(token)
    chi = size / n * sum(c * c for c in Counter(places).values()) - n
    spread = 2 / (9 * (size - 1))
    uniform = normal_above(((max(chi, 0) / (size - 1)) ** (1 / 3) - (1 - spread)) / spread**0.5)
    middle = (size - 1) / 2
    high = size // 2 / size
    change = 2 * high * (1 - high)
    changes = sum((a > middle) != (b > middle) for a, b in zip(places, places[1:]))
    runs = 2 * normal_above(abs((changes - (n - 1) * change) / ((n - 1) * change * (1 - change)) ** 0.5))
    product = sum((a - middle) * (b - middle) for a, b in zip(places, places[1:]))
    serial = 2 * normal_above(abs(product / ((n - 1) ** 0.5 * (size * size - 1) / 12)))
    x = -sum(math.log(max(min(p, 1), 1e-300)) for p in (uniform, runs, serial))
    return math.exp(-x) * (1 + x + x * x / 2)


def random_tokens(count, size, letters="ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"):
    draw = random.Random(9)
    return ["".join(draw.choices(letters, k=size)) for _ in range(count)]


def test_battery_by_hand(spark):
    tokens = [*random_tokens(20, 40), *random_tokens(5, 24, "0123456789abcdef"), "a" * 30, "abcdefghijklmnopqrstuvwxyz", "tischbeinschrankwandholzleiste"]
    got = secrets.randomness(spark.createDataFrame([(t,) for t in tokens], "token string")).collect()
    for r in got:
        assert r["p"] == pytest.approx(randomness_by_hand(r["token"]), rel=1e-6, abs=1e-12)


def test_random_keys_are_added_and_long_words_are_not(spark):
    """Keys among words of the same alphabet and length."""
    keys = random_tokens(120, 40)
    words = ["Donau" * 4 + "Dampf7" * 3 + "ab" for _ in range(60)]
    rows = [(i, f"text with {t} inside", "en", "a", 0, *["x"] * 7) for i, t in enumerate(keys + words)]
    got = {r["doc_id"]: r["added"] for r in secrets.scan(frame(spark, rows)).collect()}
    caught = [i for i in range(120) if got[i]]
    assert len(caught) >= 100 and all((s["start"], s["end"]) == (10, 50) for i in caught for s in got[i])
    assert not any(got[i] for i in range(120, 180))


def test_short_runs_of_letters_are_left_alone(spark):
    draw = random.Random(12)
    words = ["".join(draw.choices("aeinrst", k=20)) for _ in range(200)] + random_tokens(50, 24, "abcdefghijklmnopqrstuvwxyz")
    rows = [(i, f"a {w} b", "en", "a", 0, *["x"] * 7) for i, w in enumerate(words)]
    assert not any(r["added"] for r in secrets.scan(frame(spark, rows)).collect())


@pytest.mark.parametrize("least, most", [(0.3, 0.35), (0.6, 0.9)])
def test_copies_do_not_move_the_bar(spark, least, most):
    """Structured runs and keys of one class, alone and with one run of middling or high p copied very often."""
    draw = random.Random(4)
    keys = random_tokens(150, 40)
    names = ["".join(draw.choices(["Haus", "Tor9", "Baum", "Weg7"], k=10)) for _ in range(600)]
    copied = next(t for t in random_tokens(5000, 40)[200:] if least <= randomness_by_hand(t) < most)
    rows = [(i, f"text with {t} inside", "en", "a", 0, *["x"] * 7) for i, t in enumerate(keys + names)]
    copies = [(10_000 + i, f"text with {copied} inside", "en", "a", 0, *["x"] * 7) for i in range(5000)]
    added = [{r["doc_id"] for r in secrets.scan(frame(spark, x)).collect() if r["added"]} for x in (rows, rows + copies)]
    assert len({i for i in added[1] if i < 150}) >= 0.8 * 150
    assert not {i for i in added[1] if 150 <= i < 10_000}
    assert len({i for i in added[0] ^ added[1] if i < 10_000}) <= 10
    assert {i for i in added[1] if i >= 10_000} == {r[0] for r in copies}


def test_keys_glued_to_paths_are_found(spark):
    """Runs that no alphabet holds: a key behind a path, before a name, a key of base64 signs behind a dash, two keys in one run."""
    url = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"
    plain, signed = random_tokens(180, 40), random_tokens(60, 64, url)
    texts, want = [], []
    for i, key in enumerate(plain[:120]):
        before, after = [("api/v1-beta/", ""), ("", "/some-name=="), ("a_b+", "+c-d/e"), ("api/v1-beta/", f"/x-y/{plain[120 + i % 60]}")][i % 4]
        texts.append(f"é {before}{key}{after} and api/v1-beta/other/path-to/thing")
        want.append([(2 + len(before), 42 + len(before))] + [(texts[-1].index(k), texts[-1].index(k) + 40) for k in plain[120:] if k in after])
    for key in signed:
        texts.append(f"see api/v1/{key} here")
        want.append([(11, 75)])
    got = {r["doc_id"]: r["added"] for r in secrets.scan(frame(spark, [(i, t, "en", "a", 0, *["x"] * 7) for i, t in enumerate(texts)])).collect()}
    found = [{(s["start"], s["end"]) for s in got[i]} for i in range(len(texts))]
    # A span may hold a short word beside the key, never half of the key.
    covered = [all(any(a <= x and y <= b and b - a < y - x + 20 for a, b in spans) for x, y in keys) for spans, keys in zip(found, want)]
    assert sum(covered[:120]) >= 0.75 * 120 and sum(covered[120:]) >= 0.75 * 60
    assert any(spans & set(keys) for spans, keys in zip(found, want))
    for spans in found:
        assert not any(a != b and a[0] <= b[0] and b[1] <= a[1] for a in spans for b in spans)


# --- pipeline ---


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Each stage against a plain version over what the stage before it kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = docs.collect()
        if name == "toxicity":
            scored = toxicity.score_toxicity(before, toxicity.fit(before, spark.read.parquet(f"{FOLDER}/labels.parquet")))
            assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in scored.collect() if not r["predicted"]}
        elif name == "line_dedup":
            want = {d: "\n".join(lines) for d, _, lines in kept_lines([(r["doc_id"], r["text"]) for r in before.collect()])}
            assert {r["doc_id"]: r["text"] for r in kept[name]} == want
            assert all(r["n_chars"] == len(r["text"]) for r in kept[name])
        elif name == "simhash_near_dedup":
            prints = {r["doc_id"]: simhash(r["text"]) for r in before.collect()}
            top = groups(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 2)
            least = {}
            for doc_id in sorted(prints):
                least.setdefault(top[prints[doc_id]], doc_id)
            assert sorted(r["doc_id"] for r in kept[name]) == sorted(least.values())
        elif name == "mixing":
            rows = mixing.mix(mixing.sized_rows(before, mixing.label_weights(spark.read.parquet(f"{FOLDER}/labels.parquet")))).collect()
            assert Counter(r["doc_id"] for r in kept[name]) == +Counter({r["doc_id"]: r["copies"] for r in rows})
        else:
            check_packing([(r["doc_id"], r["text"]) for r in before.collect()], kept[name])
        if name != "packing":
            assert docs.columns == names


def test_pipeline_on_awkward_rows(spark, tmp_path):
    docs = frame(spark)
    spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() > 0


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_pipeline_leaves_its_result_alone(spark, tmp_path, rows):
    """The whole run, on awkward rows and on an empty table; afterwards the shared folder holds what it returns."""
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(1, 1, 0), (2, 0, 1)] if rows else []
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.rglob("*.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert (got.count() > 0) == bool(rows)
    assert {path.parent.name for path in set(shared.rglob("*.parquet")) - before} <= {"packing"}


@pytest.mark.parametrize("name", ["op3_lines", "op4_mixing", "op6_exact", "op13_trie"])
def test_many_partitions_give_the_same_rows(spark, name):
    want = bag(queries.REGISTERED[name](spark, FOLDER))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    try:
        assert bag(queries.REGISTERED[name](spark, FOLDER)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
