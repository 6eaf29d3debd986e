"""SimHash, line, exact and substring dedup against plain versions."""

from __future__ import annotations

import random
import re
from collections import Counter
from hashlib import sha256
from pathlib import Path

import pytest
from conftest import bag, plan
from fixtures import AWKWARD, FOLDER, LONG, PASSAGE, SCHEMA, frame, given, groups, imports, kept_lines, simhash  # noqa: F401

from pyspark.sql import functions as F

from clinflow.llm import components, exact, lines, queries, simhash as sh, spans
from clinflow.llm.places import by_mark, marked, with_place


def expected_components(rows):
    prints = [(doc_id, simhash(text)) for doc_id, text in rows]
    top = groups({fp for _, fp in prints}, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for doc_id, fp in prints:
        if doc_id is not None:
            least[top[fp]] = min(doc_id, least.get(top[fp], doc_id))
    return Counter((doc_id, sh.signed(fp), least.get(top[fp])) for doc_id, fp in prints)


@pytest.mark.parametrize("most", [1, 4, 2048])
def test_simhash_on_awkward_rows(spark, most):
    got = sh.near_duplicates(frame(spark), most=most).collect()
    assert Counter(map(tuple, got)) == expected_components([r[:2] for r in AWKWARD])


def test_simhash_query(spark):
    got = queries.op2_simhash(spark, FOLDER).collect()
    want = expected_components([(r["doc_id"], r["text"]) for r in given()])
    assert Counter((r["doc_id"], sh.signed(int(r["fingerprint"], 16)), r["component_id"]) for r in got) == want


@pytest.mark.parametrize("most", [2, 8, 64])
def test_links_are_whole_when_keys_are_hot(spark, most):
    """Fingerprints that share most of their bits go through all levels of shards and lose no link."""
    draw = random.Random(5)
    base = draw.getrandbits(64)
    values = {base ^ sum(1 << b for b in draw.sample(range(12), draw.randrange(7))) for _ in range(150)}
    values |= {draw.getrandbits(64) for _ in range(50)}
    want = groups({sh.signed(v) for v in values}, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2)
    distinct = spark.createDataFrame([(v,) for v in want], "fp long")
    got = dict(components.connected_components(sh.link_edges(distinct, 2, most)).collect())
    assert {v: got.get(v, v) for v in want} == want


def test_tree_finds_what_brute_force_finds():
    draw = random.Random(3)
    values = [draw.getrandbits(10) for _ in range(200)]
    tree = sh.BKTree()
    for value in set(values):
        tree.add(value)
    for value in values:
        assert sorted(tree.near(value, 2)) == sorted(v for v in set(values) if (v ^ value).bit_count() <= 2)


def test_long_paths_become_one_component(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (101, 102), (-5, 100), (7, 7)]
    got = dict(components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: -5, 101: -5, 102: -5, -5: -5}


def test_one_of_each_group_stays(spark):
    kept = sh.keep_one_of_each(frame(spark))
    assert kept.columns == frame(spark).columns
    assert sorted(map(staying, kept.collect()), key=repr) == sorted(one_of_each(AWKWARD), key=repr)
    again = sh.keep_one_of_each(frame(spark), mark_bytes=0)
    assert sorted(map(staying, again.collect()), key=repr) == sorted(one_of_each(AWKWARD), key=repr)


def staying(row):
    return row["doc_id"], simhash(row["text"])


def one_of_each(rows):
    """(doc_id, fingerprint) of the row that stays of every component, ids first, then lesser fingerprints."""
    prints = [(doc_id, simhash(text)) for doc_id, text, *_ in rows]
    top = groups({fp for _, fp in prints}, lambda a, b: (a ^ b).bit_count() <= 2)
    best = {}
    for doc_id, fp in prints:
        order = (doc_id is None, doc_id or 0, sh.signed(fp))
        best[top[fp]] = min(best.get(top[fp], (order, (doc_id, fp))), (order, (doc_id, fp)), key=lambda x: x[0])
    return [row for _, row in best.values()]


def test_unlike_texts_of_one_id_all_stay(spark):
    """Every component keeps a row, though one doc_id names several; extra columns stay with their row."""
    texts = [f"text {i} {i * i} of words {i * 31} that are {i * 101} like no other {i * 7}" for i in range(5)]
    rows = [(7, t, f"lang{i}", "a", 0, *["x"] * 7) for i, t in enumerate(texts[:3])]
    rows += [(9, texts[3], "lang3", "a", 0, *["x"] * 7), (9, texts[0], "copy", "a", 0, *["x"] * 7)]
    kept = sh.keep_one_of_each(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["text"], r["lang"]) for r in kept) == sorted((r[0], r[1], r[2]) for r in rows[:4])


def test_texts_without_a_copy_do_not_move(spark):
    """Kept rows are found where they lie: the plan of the result has no exchange but the broadcast of bits."""
    text = plan(sh.keep_one_of_each(spark.read.parquet(f"{FOLDER}/documents.parquet")))
    assert "hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_the_text_that_stays_is_no_copy_of_another(spark):
    """Ids of two texts, one of them a copy of a lesser document: the other one stays, wherever the rows lie."""
    copies = [f"text {i} {i * i} that another document holds as well" for i in range(1, 9)]
    rows = [(i, t) for i, t in enumerate(copies)] + [(100 + i, t) for i, t in enumerate(copies)]
    lone = [(100 + i, f"nothing else {i * 7} is like {i * 31} this one {i * 101} at all") for i in range(len(copies))]
    found = dict.fromkeys(simhash(t) for _, t in rows + lone)
    assert all((a ^ b).bit_count() > 2 for a in found for b in found if a != b) and len(found) == 16
    for parts in (1, 4):
        docs = frame(spark, [(i, t, "en", "a", 0, *["x"] * 7) for i, t in rows + lone]).repartition(parts)
        kept = sh.keep_one_of_each(docs).collect()
        assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted(rows[: len(copies)] + lone)


@pytest.mark.parametrize("batches, fan, mark_bytes", [(1, 2, 1 << 20), (4, 2, 0), (5, 3, 1 << 20)])
def test_lines_on_awkward_rows(spark, batches, fan, mark_bytes):
    settings = lines.LineSettings(batches=batches, fan=fan, mark_bytes=mark_bytes)
    got = lines.drop_repeated_lines(frame(spark), settings)
    want = kept_lines([r[:2] for r in AWKWARD])
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect()) == Counter(
        (doc_id, n, n - len(kept), "\n".join(kept)) for doc_id, n, kept in want
    )


def test_lines_run_without_python(spark):
    text = plan(queries.op3_lines(spark, FOLDER))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_line_runs_are_sorted_and_hold_each_key_once(spark, tmp_path):
    """Whatever the batches, the runs together have every key once, and no more runs than levels allow."""
    path = str(tmp_path / "lines")
    lines.line_table(with_place(spark.read.parquet(f"{FOLDER}/documents.parquet")), 5).write.parquet(path)
    table = spark.read.parquet(path)
    runs = lines.LineRuns(spark, fan=2)
    try:
        for part in (3, 2, 1, 0):
            condition = F.col("doc_id") % 4 == part
            if part == 0:
                # A batch against a run: neither a shuffle nor a sort of the run, only those of the batch.
                text = plan(runs.joined(path, condition))
                # Two exchanges count the distinct documents of the batch, before any join.
                assert text.count("Arguments: hashpartitioning") == 2 and text.count("SortMergeJoin LeftOuter") == len(runs.runs()) == 2
                assert len(re.findall(r"^\(\d+\) Sort ", text, re.M)) == 1 and "Bucketed: true" in text
            runs.add(path, condition)
        assert all(len(level) < 2 for level in runs.first.values())
        found = [run.collect() for run in runs.runs()]
        keys = [tuple(r[k] for k in lines.KEY) for run in found for r in run]
        assert len(keys) == len(set(keys)) == table.select(*lines.KEY).distinct().count()
        for name, folder in runs.tables.items():
            files = Counter(f.name.split("_")[-1] for f in Path(folder).glob("*.parquet"))
            assert set(files.values()) == {1}, name  # one file a bucket at every level
        one, other = runs.first[2][0], runs.first[2][0]
        text = plan(runs.merged(one, other))
        assert "Exchange" not in text and not re.search(r"^\(\d+\) Sort ", text, re.M)
    finally:
        runs.drop()


@pytest.mark.parametrize("mark_bytes", [0, 5_000, 64 << 20])
def test_exact_on_awkward_rows(spark, tmp_path, mark_bytes):
    """With the bits of all files at once, of some files at a time, and joined by a shuffle."""
    path = str(tmp_path / "documents.parquet")
    frame(spark).write.parquet(path)
    for digest in (exact.sha256, lambda text: F.substring(exact.sha256(text), 1, 1) == F.unhex(F.lit("00"))):
        # The second digest lets nearly all texts collide: only their bytes tell them apart.
        got = exact.exact_duplicates(spark, path, exact.ExactSettings(mark_bytes=mark_bytes), digest=digest).collect()
        texts = [(r[0], r[1] or "") for r in AWKWARD]
        size = Counter(t for _, t in texts)
        keep = {t: max((d for d, u in texts if u == t and d is not None), default=None) for t in size}
        want = Counter((d, keep[t], size[t], sha256(t.encode()).hexdigest()) for d, t in texts)
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
        kept = [r for r in got if r["kept"]]
        assert all(r["doc_id"] == r["keep_id"] for r in kept)
        assert Counter(r["text_sha256"] for r in kept) == Counter(sha256(t.encode()).hexdigest() for t in size)


@pytest.mark.parametrize("most_bytes", [0, 5_000, 1 << 20])
def test_marked_rows_are_those_of_the_marks(spark, tmp_path, most_bytes):
    """Any subset of the rows of many files, group by group, each file in one group."""
    path = str(tmp_path / "rows")
    spark.range(70_000).repartition(7).write.parquet(path)
    rows = with_place(spark.read.parquet(path))
    marks = rows.filter("id % 3 = 0 or id > 69000")
    groups = marked(rows, marks, most_bytes)
    assert len(groups) == 1 if most_bytes > 100_000 else len(groups) > 3
    found = by_mark(rows, marks, lambda r: r.select("id", "__marked"), most_bytes).collect()
    assert Counter((r[0], r[1]) for r in found) == Counter((i, i % 3 == 0 or i > 69_000) for i in range(70_000))


def test_state_takes_little_disk_in_many_partitions(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    path = str(tmp_path / "documents.parquet")
    frame(spark).write.parquet(path)
    local = Path(spark.conf.get("spark.local.dir", "/tmp"))
    used = lambda: sum(f.lstat().st_blocks for d in local.glob("spark*") for f in d.rglob("*.log") if f.is_file()) * 512
    start = used()
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    try:
        exact.update_state(spark, path, str(tmp_path / "state"), exact.ExactSettings(), exact.sha256)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert used() - start < 100 << 20


def test_state_goes_on_where_it_ended(spark, tmp_path):
    path, checkpoint = str(tmp_path / "documents.parquet"), str(tmp_path / "state")
    settings = exact.ExactSettings()
    for rows in (AWKWARD[:8], AWKWARD[8:]):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(path)
        exact.update_state(spark, path, checkpoint, settings, exact.sha256)
    sizes = Counter(r["group_size"] for r in exact.read_state(spark, checkpoint).collect())
    assert sizes == Counter(Counter(r[1] or "" for r in AWKWARD).values())


def _spans_by_hand(rows, settings):
    """doc_id -> kept text, by a dictionary of all spans."""
    first, found = {}, {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        parts = spans.placed_sentences(text or "", settings.longest)
        own = list(spans.spans([len(w) for _, _, w in parts], settings.least_sentences, settings.least_words))
        found[doc_id] = (text or "", parts, own)
        for a, b in own:
            first.setdefault(tuple(tuple(w) for _, _, w in parts[a : b + 1]), (doc_id, a))
    out = {}
    for doc_id, (text, parts, own) in found.items():
        gone = {i for a, b in own if first[tuple(tuple(w) for _, _, w in parts[a : b + 1])] != (doc_id, a) for i in range(a, b + 1)}
        out[doc_id] = "".join(text[s:e] for i, (s, e, _) in enumerate(parts) if i not in gone) if parts else text
    return out


def test_line_runs_leave_no_tables(spark):
    before = {t.name for t in spark.catalog.listTables()}
    assert lines.drop_repeated_lines(frame(spark)).count()
    assert {t.name for t in spark.catalog.listTables()} == before


@pytest.mark.parametrize("mark_bytes", [0, 1 << 20])
def test_spans_on_awkward_rows(spark, mark_bytes):
    settings = spans.SpanSettings(mark_bytes=mark_bytes)
    unique = {r[0]: r for r in AWKWARD}
    got = {r["doc_id"]: r for r in spans.drop_repeated_spans(frame(spark, list(unique.values())), settings).collect()}
    want = _spans_by_hand([r[:2] for r in unique.values()], settings)
    assert {d: r["text"] for d, r in got.items()} == want
    assert PASSAGE[:60] in got[9]["text"] and "It looked at the rain" not in got[10]["text"]
    assert got[8]["text"] != LONG + " more" and got[4]["text"] == "" and got[4]["n_sentences"] == 0


def test_spans_take_all_rows_and_repeated_rows(spark):
    got = spans.drop_repeated_spans(frame(spark))
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(r[0] for r in AWKWARD)


@pytest.mark.parametrize("mark_bytes", [0, 1 << 20])
def test_spans_of_repeated_ids_and_of_many_rows_without_one(spark, mark_bytes):
    """Rows of one doc_id keep a span they have at the same place; of rows without doc_id each loses what it repeats."""
    rows = [(1, f"{PASSAGE} Own end one."), (1, f"{PASSAGE} Own end two."), (2, f"Start here. {PASSAGE}")]
    rows += [(None, f"Nameless row {i} of many. {PASSAGE}") for i in range(200)]
    docs = spark.createDataFrame([(*r, "en", "a", 0, *["x"] * 7) for r in rows], SCHEMA).repartition(3)
    got = spans.drop_repeated_spans(docs, spans.SpanSettings(mark_bytes=mark_bytes)).collect()
    assert len(got) == len(rows)
    assert sorted(r["text"] for r in got if r["doc_id"] == 1) == sorted(r[1] for r in rows[:2])
    losing = [r for r in got if r["doc_id"] != 1]
    assert all("It looked at the rain" not in r["text"] for r in losing) and len(losing) == 201
    assert {r["text"][:15] for r in losing if r["doc_id"] is None} == {f"Nameless row {i} of"[:15] for i in range(200)}


@pytest.mark.parametrize("text", ["", "  ", " \n\n a b.  c\n", "one. \n two \n" + "x y z " * 40, "a\n" * 50, "\u00e9t\u00e9\u00a0d'or ! " * 30])
def test_sentences_cover_the_text(text):
    placed = spans.placed_sentences(text, 8)
    assert "".join(text[s:e] for s, e, _ in placed) == (text if placed else "")
    assert [words for _, _, words in placed] == spans.sentences(text, 8)
    assert [w for words in spans.sentences(text, 8) for w in words] == text.split()
    assert all(len(words) <= 8 for words in spans.sentences(text, 8))
    assert spans.count_sentences(text, 8) == len(placed)


def test_sentences_end_at_marks_and_line_breaks():
    """Against the rule letter by letter: space behind a mark, or a line break with the space behind it."""
    rng = random.Random(5)
    for _ in range(500):
        text = "".join(rng.choices(["a", "b ", ".", ". ", "!", "\n", " \n", "\t", "? \n"], k=rng.randrange(40)))
        want, words = [], []
        for part in re.split(r"(\s+)", text):
            if not part.isspace():
                words += [part] if part else []
            elif words and (words[-1][-1] in ".!?" or "\n" in part):
                want, words = [*want, words], []
        want += [words] if words else []
        assert spans.sentences(text, 99) == want and spans.count_sentences(text, 99) == len(want)


def test_spans_find_a_passage_within_any_sentence(spark):
    """A passage without sentence ends loses all but three pieces at its ends, however many words stand before and after it."""
    rng = random.Random(3)

    def words(n):
        return " ".join("".join(rng.choices("abcdefghij", k=4)) for _ in range(n))

    rows, passages = [], {}
    for i in range(0, 120, 2):
        passages[i + 1] = words(51)
        rows += [(d, f"{words(rng.randrange(40))} {passages[i + 1]} {words(rng.randrange(40))}", "en", "a", 5, *["x"] * 7) for d in (i, i + 1)]
    got = {r["doc_id"]: r for r in spans.drop_repeated_spans(frame(spark, rows)).collect()}
    for d, passage in passages.items():
        whole = next(r[1] for r in rows if r[0] == d)
        gone = len(whole.split()) - len(got[d]["text"].split())
        # Up to a piece before the first common cut, one after the last, and one that no span ends with.
        assert 51 - 3 * 8 <= gone <= 51 and got[d - 1]["n_removed"] == 0


def test_spans_query(spark):
    got = {r["doc_id"]: r["text"] for r in queries.op7_spans(spark, FOLDER).collect()}
    assert got == _spans_by_hand([(r["doc_id"], r["text"]) for r in given()], spans.SpanSettings())


def test_empty_tables(spark, tmp_path):
    empty = frame(spark, [])
    assert sh.near_duplicates(empty).count() == 0
    assert sh.keep_one_of_each(empty).count() == 0
    assert lines.drop_repeated_lines(empty).count() == 0
    assert spans.drop_repeated_spans(empty).count() == 0
    path = str(tmp_path / "documents.parquet")
    empty.write.parquet(path)
    assert exact.exact_duplicates(spark, path).count() == 0


def test_hot_copies(spark):
    """A third of all rows is one text: counts stay whole."""
    rows = [(i, "the same words every time again", "en", "a", 5, *["x"] * 7) for i in range(400)]
    rows += [(i, f"row number {i} is like no other row {i * 7}", "en", "a", 5, *["x"] * 7) for i in range(400, 1200)]
    found = sh.near_duplicates(frame(spark, rows)).filter("doc_id < 400")
    assert bag(found.select("component_id")) == Counter({("0",): 400})
