"""Both classifiers: held-out accuracy, defined results, and their parts against plain versions."""

from __future__ import annotations

import numpy as np
import pytest
from fixtures import AWKWARD, frame, given, held_out, imports  # noqa: F401
from hypothesis import given as cases, settings, strategies as st

from pyspark.sql import functions as F

from clinflow.llm import quality, queries, toxicity
from clinflow.llm.text import held_out as held_out_column, in_slices

LARGER = "/root/testdata/sf0.1"


def accuracy(rows, label, of=1):
    labels = {r["doc_id"]: r[label] for r in given(LARGER, "labels")}
    judged = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    return sum(p == y for p, y in judged) / len(judged), sum(p == 1 for p, y in judged if y == of) / sum(y == of for _, y in judged)


# Some documents that the small tables call toxic hold no word that tells them from others, so not all can be caught.
@pytest.mark.parametrize("name, label, least, least_caught", [("op1_quality", "quality", 0.97, 0.97), ("op5_toxicity", "toxic", 0.96, 0.85)])
def test_held_out_accuracy(spark, name, label, least, least_caught):
    rows = queries.REGISTERED[name](spark, LARGER).collect()
    assert len(rows) == len(given(LARGER))
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    right, caught = accuracy(rows, label)
    assert right >= least and caught >= least_caught


def labels(spark, rows=((1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (7, 1, 0), (7, 0, 1), (7, 1, 0), (99, 1, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("known", [(), ((1, 1, 0), (2, 0, 1), (9, 1, 0), (10, 1, 0), (None, 1, 1), (3, None, None))])
def test_awkward_rows_are_scored(spark, known):
    docs, known = frame(spark), labels(spark, known)
    for found in (
        quality.score_quality(docs, quality.fit(docs, known)),
        toxicity.score_toxicity(docs, toxicity.fit(docs, known)),
    ):
        rows = found.collect()
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in AWKWARD)
        assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
        empty = {r["score"] for r in rows if r["doc_id"] in (4, 5, 6)}
        assert len(empty) == 1
    left = toxicity.drop_toxic(docs, toxicity.fit(docs, known))
    assert left.schema == docs.schema


def test_labels_of_held_out_rows_are_not_learnt(spark):
    docs = frame(spark)
    known = labels(spark)
    swapped = known.withColumn("toxic", F.when(held_out_column(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    swapped = swapped.withColumn("quality", F.when(held_out_column(), 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [sorted((str(r["doc_id"]), r["score"]) for r in toxicity.score_toxicity(docs, toxicity.fit(docs, x)).collect()) for x in (known, swapped)]
    assert scores[0] == scores[1]
    scores = [sorted((str(r["doc_id"]), r["score"]) for r in quality.score_quality(docs, quality.fit(docs, x)).collect()) for x in (known, swapped)]
    assert scores[0] == scores[1]


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert quality.score_quality(empty, quality.fit(empty, labels(spark))).count() == 0
    assert toxicity.score_toxicity(empty, toxicity.fit(empty, labels(spark, ()))).count() == 0


def all_maximal(scores):
    """Maximal segments by their definition: take the best segment, then go on left and right of it."""
    best = max(((sum(scores[a:b]), -(b - a), -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=None)
    if best is None or best[0] <= 0:
        return []
    _, _, _, a, b = best
    left, right = all_maximal(scores[:a]), all_maximal(scores[b:])
    return left + [(a, b)] + [(s + b, e + b) for s, e in right]


@settings(max_examples=200, deadline=None)
@cases(st.lists(st.sampled_from([-3, -2, -1, 1, 2, 4]), max_size=14))
def test_segments_are_the_maximal_ones(scores):
    # Distinct fractions, so that no two segments tie.
    exact = [s + 2.0**-i / 64 for i, s in enumerate(scores, start=1)]
    found = [(a, b) for a, b, _ in toxicity.segments(np.array(exact))]
    assert found == all_maximal(exact)


def test_votes_are_those_of_the_nearest():
    rng = np.random.default_rng(1)
    vectors = quality.unit(rng.standard_normal((40, 6)).astype(np.float32))
    labels = (rng.random(40) > 0.4).astype(float)
    settings = quality.QualitySettings(neighbours=5, sharpness=2)
    model = quality.QualityModel(np.ones(6, np.float32), np.eye(6, dtype=np.float32), vectors, labels, settings)
    asked = np.abs(rng.standard_normal((9, 6))).astype(np.float32)
    for row, score in zip(asked, model.scores(asked)):
        cosines = vectors @ (row / np.linalg.norm(row))
        near = np.argsort(-cosines)[:5]
        weights = np.clip(cosines[near], 0, None) ** 2
        assert score == pytest.approx((weights * labels[near]).sum() / weights.sum(), rel=1e-4)


def test_a_repeated_word_is_no_more_evidence():
    model = toxicity.ToxicityModel({"bad": 5.0}, {}, toxicity.ToxicitySettings())
    scores = toxicity.TokenScores(model.words, model.classes, model.settings)
    _, once = model.scan("so bad it is", scores)
    _, often = model.scan("so bad bad bad bad it is", scores)
    assert [s[2] for s in once] == [s[2] for s in often]


def test_long_toxic_documents_are_found(spark):
    """Held-out clean documents joined to 50,000 tokens and more, as they are and with insults among their words."""
    docs, known = (spark.read.parquet(f"{LARGER}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit(docs, known)
    scores = toxicity.TokenScores(model.words, model.classes, model.settings)
    clean = {r["doc_id"] for r in known.filter("toxic = 0").collect() if held_out(r["doc_id"])}
    texts = [r["text"].split() for r in sorted(given(LARGER), key=lambda r: r["doc_id"]) if r["doc_id"] in clean and r["text"]]
    rng = np.random.default_rng(3)

    def rejected(size, insults, share):
        count = 0
        for _ in range(10):
            tokens = []
            while len(tokens) < size:
                tokens += texts[rng.integers(len(texts))]
            tokens = [insults[rng.integers(len(insults))] if rng.random() < share else token for token in tokens]
            evidence, passages = model.evidence(*model.scan(" ".join(tokens), scores))
            assert len(passages) >= min(share, 0.01) * size / 4
            count += model.probability(evidence) >= model.settings.threshold
        return count

    insults = "idiot trash pathetic moron stupid worthless disgusting scum clown".split()
    for size in (50_000, 150_000):
        assert rejected(size, insults, 0.01) == 10
        assert rejected(size, insults[:1], 0.001) == 10
        assert rejected(size, insults, 0.1) == 10
        assert rejected(size, insults, 0) <= 1


def test_slices_keep_all_rows():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([None, "a" * 50, "", "b" * 10, "c" * 200])], ["text"])
    pieces = list(in_slices([batch], most=60))
    assert [r for p in pieces for r in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert len(pieces) > 1
