"""Both classifiers whole against plain versions: bags, weights, decomposition and vote; log-odds, rate, bar and evidence."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from fixtures import given, held_out, imports  # noqa: F401

from clinflow.llm import quality, queries, toxicity

SMALL = "/root/testdata/sf0.01"


def labelled(label):
    texts = {r["doc_id"]: r["text"] or "" for r in given(SMALL)}
    known = {}
    for r in given(SMALL, "labels"):
        if r[label] is not None and not held_out(r["doc_id"]) and r["doc_id"] in texts:
            known[r["doc_id"]] = r[label]
    return texts, known


def plain_bag(text, size):
    """feature -> damped count, from names of features."""
    words = text.split()
    counts = Counter()
    for word in words:
        shape = ""
        for c in word:
            kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
            shape += kind if not shape.endswith(kind) else ""
        for name in ("w" + word.strip("\"'().,;:!?").lower(), "s" + shape, "e" + word[-2:]):
            counts[crc32(name.encode()) % size] += 1
    if words:
        top = max(Counter(words).values())
        for name in (f"=distinct{int(len(set(words)) / len(words) * 10)}", f"=top{int(top / len(words) * 10)}"):
            counts[crc32(name.encode()) % size] += len(words)
    return {feature: math.log1p(n) for feature, n in counts.items()}


def test_quality_whole(spark):
    """With as many dimensions as labelled rows the decomposition loses nothing, so cosines follow from the bags alone."""
    texts, known = labelled("quality")
    settings = quality.QualitySettings(dimensions=400)
    ids = sorted(known)
    bags = {d: plain_bag(t, settings.features) for d, t in texts.items()}
    frequency = Counter(f for d in ids for f in bags[d])
    idf = {f: math.log((1 + len(ids)) / (1 + frequency.get(f, 0))) + 1 for f in range(settings.features)}

    def vector(doc_id):
        out = np.zeros(settings.features)
        for f, x in bags[doc_id].items():
            out[f] = x * idf[f]
        size = np.linalg.norm(out)
        return out / size if size else out

    rows = np.array([vector(d) for d in ids])
    # What a document has in common with the labelled ones: its part in the space they span.
    _, values, basis = np.linalg.svd(rows, full_matrices=False)
    basis = basis[values > 1e-6]
    shared = rows @ basis.T
    shared /= np.maximum(np.linalg.norm(shared, axis=1, keepdims=True), 1e-30)
    y = np.array([known[d] for d in ids], float)
    docs, labels = (spark.read.parquet(f"{SMALL}/{name}.parquet") for name in ("documents", "labels"))
    got = {r["doc_id"]: r for r in quality.score_quality(docs, quality.fit(docs, labels, settings)).collect()}
    assert len(got) == len(texts)
    near, checked = 0, 0
    for doc_id in sorted(texts)[::3]:
        own = basis @ vector(doc_id)
        size = np.linalg.norm(own)
        if not size:
            assert got[doc_id]["score"] == pytest.approx(y.mean(), abs=1e-6)
            continue
        cosines = shared @ (own / size)
        chosen = np.argsort(-cosines, kind="stable")[: settings.neighbours]
        weights = np.clip(cosines[chosen], 0, None) ** settings.sharpness
        checked += 1
        near += abs((weights * y[chosen]).sum() / weights.sum() - got[doc_id]["score"]) < 5e-3
        assert got[doc_id]["predicted"] == int(got[doc_id]["score"] >= 0.7) and got[doc_id]["held_out"] == held_out(doc_id)
    # The rest are ties: copies among the labelled rows, of which either may be the last neighbour.
    assert near >= 0.95 * checked > 200


def test_toxicity_whole(spark):
    texts, known = labelled("toxic")
    settings = toxicity.ToxicitySettings()
    by_text = {}
    for d, y in known.items():
        by_text[texts[d]] = max(y, by_text.get(texts[d], 0))
    n = Counter(by_text.values())
    words, classes = defaultdict(Counter), defaultdict(Counter)
    for text, y in by_text.items():
        bare = {toxicity.bare(t) for t in text.split()}
        for w in bare:
            words[w][y] += 1
        for c in {w[:4] for w in bare}:
            classes[c][y] += 1

    def odds(counts):
        mass = settings.prior * (counts[0] + counts[1]) / (n[0] + n[1])
        toxic, clean = counts[1] + mass, counts[0] + mass
        found = math.log(toxic / (n[1] + settings.prior)) - math.log(clean / (n[0] + settings.prior))
        slack = math.sqrt(1 / toxic + 1 / clean)
        return math.copysign(max(abs(found) - slack, 0.0), found)

    docs, labels = (spark.read.parquet(f"{SMALL}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    several = {c: counts for c, counts in classes.items() if sum(counts.values()) > 1}
    assert model.classes == pytest.approx({c: odds(counts) for c, counts in several.items()}, abs=1e-9)
    want = {}
    for w, counts in words.items():
        score, shared = odds(counts), odds(classes[w[:4]])
        if sum(counts.values()) > 1 and (score * shared < 0 or abs(score) > abs(shared)):
            want[w] = score
    assert model.words == pytest.approx(want, abs=1e-9)

    # The rate at which sums of ordinary tokens die out, by its equation.
    step = {w: model.words.get(w, model.classes.get(w[:4], 0.0)) - settings.drift for w in words if sum(words[w].values()) > 1}
    clean = {w: words[w][0] for w in step}
    moment = sum(k * math.exp(model.rate * step[w]) for w, k in clean.items()) / sum(clean.values())
    assert moment == pytest.approx(1, abs=1e-6) or model.rate in (pytest.approx(0.05, abs=1e-6), pytest.approx(1.0, abs=1e-6))

    # Evidence and bar of whole documents: segments alone, and the best r of them together.
    scores = toxicity.TokenScores(model.words, model.classes, settings)
    got = {r["doc_id"]: r for r in queries.op5_toxicity(spark, SMALL).collect()}
    for doc_id in sorted(texts)[::4]:
        tokens, found = model.scan(texts[doc_id], scores)
        assert tokens == len(texts[doc_id].split())
        evidence = 0.0
        for _, _, x in found:
            evidence = max(evidence, model.rate * x - math.log(model.constant * tokens))
        together = 0.0
        for r, x in enumerate(sorted((s[2] for s in found), reverse=True)):
            chance = math.log(model.constant) - model.rate * x
            at = min(int(x / 0.05), len(model.common) - 1)
            chance = max(chance, float(model.common[at]))
            together += math.log(r + 1) - chance - math.log(tokens)
            evidence = max(evidence, together - settings.spread * r)
        logit = model.slope * min(evidence, 50.0) + model.offset
        assert got[doc_id]["score"] == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-9)
        assert got[doc_id]["predicted"] == int(got[doc_id]["score"] >= 0.3)
        # Every segment sums what its tokens score: first mentions whole, repeats within reach less.
        for start, end, x in found:
            plain = sum(scores[t] for t in texts[doc_id].split()[start:end])
            assert 0 < x <= plain + 1e-9
