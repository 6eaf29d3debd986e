"""Toxicity: maximum-scoring segments over token log-odds, with extreme-value calibration.

Tokens are scored by the log-odds of toxic against clean documents under Dirichlet priors, drawn to zero by their
standard error; a word that tells little by itself scores like its class, the words with the same first letters. Scores are
lowered by a drift, so that ordinary text sums to less than nothing. A linear scan then finds all maximal
segments of a document. The best sum of ordinary text follows an extreme-value law whose
rate solves sum p(w) exp(rate * s(w)) = 1 and whose constant is fitted to clean labelled documents; a segment
is significant if fewer than ``expected`` such segments are due to chance in a text of that length. Segments that are not
significant alone may be so together: the evidence of the best r of all segments adds up (sum statistics), so that it grows
with the mentions in a long text as its bar does. Small sums are more frequent in ordinary text than the law says; for those the
chance is the share counted in clean labelled documents. A logistic curve fitted to the labels makes the evidence a
probability.

The model learns from a bounded sample of labelled rows; scoring is one narrow pass over all whole texts.

Defined results: a NULL or empty text holds no segment and gets the score of no evidence; without labels of both
kinds there is no evidence anywhere and no text is rejected. Repeated rows score alike, and rows without doc_id like any other;
none of those is learnt from or held out. Of a text that labels call both, toxic counts. Segments of equal sum rank by their place.
Texts of any length are scanned whole. An empty table gives an empty result. Extra columns are not read; ``drop_toxic`` passes
them through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clinflow.llm.labelled import labelled_sample
from clinflow.llm.text import held_out, in_slices

_EDGE = "\"'`()[]{}<>.,;:!?*&$%#|-_"
_EULER = 0.5772156649
# Width of the classes in which sums of ordinary text are counted.
_STEP = 0.05


@dataclass(frozen=True)
class ToxicitySettings:
    """``sample``: labelled rows learnt from, at most; ``words``: the model's vocabulary, at most (the most frequent
    of the sample; others are judged by their class). ``prior``: documents the prior counts for; ``errors``: standard errors
    by which log-odds shrink; ``expected``: chance segments a document may hold before one is significant. ``reach``: tokens
    after which a word said before is told anew; ``spread``: log of how many times as often as on average an ordinary
    document may hold segments of some sum."""

    sample: int = 8192
    words: int = 200_000
    letters: int = 4
    prior: float = 30.0
    errors: float = 1.0
    drift: float = 0.4
    expected: float = 0.05
    reach: int = 100
    spread: float = 1.5
    threshold: float = 0.3


def bare(token: str) -> str:
    return token.strip(_EDGE).lower()


def log_odds(toxic: int, clean: int, all_toxic: int, all_clean: int, settings: ToxicitySettings) -> float:
    """Log-odds that a toxic rather than a clean document holds a token, by documents with it on either side.

    The prior is a Dirichlet centred on the share of all documents that hold it; the result shrinks by its standard error.
    """
    mass = settings.prior * (toxic + clean) / (all_toxic + all_clean)
    a, b = toxic + mass, clean + mass
    found = log(a / (all_toxic + settings.prior)) - log(b / (all_clean + settings.prior))
    slack = settings.errors * (1 / a + 1 / b) ** 0.5
    return found - slack if found > slack else found + slack if found < -slack else 0.0


class TokenScores(dict):
    """token as written -> its score in the scan; forgets all when it grows too large."""

    def __init__(self, words: dict[str, float], classes: dict[str, float], settings: ToxicitySettings):
        super().__init__()
        self.words, self.classes, self.settings = words, classes, settings

    def __missing__(self, token: str) -> float:
        if len(self) >= 500_000:
            self.clear()
        word = bare(token)
        shared = self.classes.get(word[: self.settings.letters], 0.0)
        self[token] = self.words.get(word, shared) - self.settings.drift
        return self[token]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, sum), disjoint, left to right, in linear time.

    Only positive scores can begin or end a segment, so the scan steps over those; for each candidate it
    keeps the cumulative sum before and after it and a link to the nearest candidate with a lower sum before it.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    total = np.cumsum(scores)
    found: list[list] = []  # start, end, sum before, sum after, link
    for at in positive.tolist():
        after = float(total[at])
        start, before = at, after - float(scores[at])
        link = len(found) - 1
        while True:
            while link >= 0 and found[link][2] >= before:
                link = found[link][4]
            if link < 0 or found[link][3] >= after:
                found.append([start, at + 1, before, after, link])
                break
            start, before, link = found[link][0], found[link][2], found[link][4]
            while len(found) and found[-1][0] >= start:
                found.pop()
    return [(start, end, after - before) for start, end, before, after, _ in found]


@dataclass
class ToxicityModel:
    words: dict[str, float]
    classes: dict[str, float]
    settings: ToxicitySettings
    rate: float = 1.0
    constant: float = 1.0
    # Log of the segments a token of clean text that sum to 0, _STEP, 2 * _STEP and so on, or more.
    common: np.ndarray = field(default_factory=lambda: np.array([-np.inf]))
    slope: float = 0.0
    offset: float = -2.0

    def scan(self, text: str | None, scores: TokenScores) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of tokens, and all maximal segments in tokens."""
        tokens = (text or "").split()
        found = np.fromiter(map(scores.__getitem__, tokens), float, len(tokens))
        # Log-odds are those of holding a word: said again in the same passage, it is no more evidence; in another one it is.
        told: dict[str, int] = {}
        for at in np.flatnonzero(found > 0).tolist():
            if at - told.get(tokens[at], -self.settings.reach) < self.settings.reach:
                found[at] = -self.settings.drift
            else:
                told[tokens[at]] = at
        return len(tokens), segments(found)

    def chance(self, sums: np.ndarray) -> np.ndarray:
        """Log of the segments of at least these sums that a token of ordinary text is expected to hold."""
        place = np.minimum((sums / _STEP).astype(np.int64), len(self.common) - 1)
        return np.maximum(log(self.constant) - self.rate * sums, self.common[place])

    def evidence(self, tokens: int, found: list[tuple[int, int, float]]) -> tuple[float, list[tuple[int, int, float]]]:
        """Evidence of all segments together, and those segments that are significant alone or together."""
        if not tokens or not found:
            return 0.0, []
        sums = np.array([s[2] for s in found])
        alone = self.rate * sums - log(self.constant * tokens)
        order = np.argsort(-sums, kind="stable")
        ranks = np.arange(len(sums))
        # Of r segments: log r! less what is expected of each; the first need not stand out from other documents.
        together = np.cumsum(np.log(ranks + 1) - self.chance(sums[order]) - log(tokens)) - self.settings.spread * ranks
        best = int(together.argmax())
        bar = -log(self.settings.expected)
        telling = alone > bar
        if together[best] > bar:
            telling[order[: best + 1]] = True
        # Segments that are not significant still tell a little: the best of them counts below the bar.
        return max(float(together[best]), float(alone.max()), 0.0), [found[i] for i in np.flatnonzero(telling).tolist()]

    def probability(self, evidence: float) -> float:
        return 1 / (1 + exp(-min(max(self.slope * min(evidence, 50.0) + self.offset, -30.0), 30.0)))


def fit(docs: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings(), label: str = "toxic") -> ToxicityModel:
    """Learn from the sample, copies of a text once.

    The sample is cut in two: the extreme-value law and the logistic curve are fitted to each half as the words of
    the other half score it, since texts look calmer, or worse, to a model that has seen them.
    """
    sample = labelled_sample(docs, labels, label, settings.sample)
    texts = sample.groupBy("text").agg(F.max("y").alias("y")).withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int"))

    def held(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents with each word or class of words, by half and label."""
        for batch in in_slices(batches):
            counts: dict[tuple[str, bool], list[int]] = {}
            for text, y, half in zip(*(batch.column(c).to_pylist() for c in ("text", "y", "half"))):
                words = {bare(token) for token in text.split()}
                for key in {(w, False) for w in words} | {(w[: settings.letters], True) for w in words} | {(None, True)}:
                    counts.setdefault(key, [0, 0, 0, 0])[2 * half + y] += 1
            columns = [[w for w, _ in counts], [c for _, c in counts], list(counts.values())]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.list_(pa.int64()))], ["word", "class", "n"])

    parts = texts.mapInArrow(held, "word string, class boolean, n array<long>").groupBy("word", "class")
    sums = parts.agg(F.array(*[F.sum(F.get("n", F.lit(i))) for i in range(4)]).alias("n"))
    size = F.aggregate("n", F.lit(0).cast("long"), lambda s, x: s + x)
    # A word of one document alone never outweighs its standard error.
    top = sums.filter(size > 1).orderBy(F.desc(size), "class", "word").limit(2 * settings.words).toArrow().combine_chunks()
    words, of_class = top["word"].to_pylist(), top["class"].to_pylist()
    counts = np.array(top["n"].combine_chunks().flatten(), np.int64).reshape(-1, 2, 2)  # by half and label
    halves = [_model(words, of_class, counts[:, half], settings) for half in (0, 1)]
    model = _model(words, of_class, counts.sum(axis=1), settings)
    plain = [i for i, word in enumerate(words) if word is not None and not of_class[i]]
    return _calibrate(model, halves, [words[i] for i in plain], counts[plain].sum(axis=1)[:, 0], texts)


def _model(words: list[str | None], of_class: list[bool], counts: np.ndarray, settings: ToxicitySettings) -> ToxicityModel:
    """Scores of classes, and of the words that tell more than their class, from documents (clean, toxic) with each.

    The entry without a word counts all documents.
    """
    model = ToxicityModel({}, {}, settings)
    all_clean, all_toxic = next((n.tolist() for word, n in zip(words, counts) if word is None), (0, 0))
    if not all_clean or not all_toxic:
        return model
    own: dict[str, float] = {}
    for word, shared, (clean, toxic) in zip(words, of_class, counts.tolist()):
        if word is not None and clean + toxic:
            (model.classes if shared else own)[word] = log_odds(toxic, clean, all_toxic, all_clean, settings)
    for word, score in own.items():
        shared = model.classes.get(word[: settings.letters], 0.0)
        if score * shared < 0 or abs(score) > abs(shared):
            model.words[word] = score
    return model


def _calibrate(
    model: ToxicityModel, halves: list[ToxicityModel], words: list[str], clean: np.ndarray, texts: DataFrame
) -> ToxicityModel:
    """Fit the extreme-value law to clean text and the logistic curve to all labelled texts."""
    settings = model.settings
    scores = TokenScores(model.words, model.classes, settings)
    steps = np.array([scores[word] for word in words])
    if clean.sum() and (steps > 0).any():
        model.rate = _rate(clean / clean.sum(), steps)

    def scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = [TokenScores(half.words, half.classes, settings) for half in halves]
        for batch in in_slices(batches):
            pairs = zip(batch.column("text").to_pylist(), batch.column("half").to_pylist())
            found = [model.scan(text, scores[1 - half]) for text, half in pairs]
            # Sums by class, so that a text gives few numbers however long it is.
            classes = [Counter(int(s[2] / _STEP) for s in segs) for _, segs in found]
            columns = [batch.column("y"), pa.array([n for n, _ in found], pa.int64()), pa.array([max((s[2] for s in segs), default=None) for _, segs in found], pa.float64())]
            columns += [pa.array([sorted(c) for c in classes], pa.list_(pa.int64())), pa.array([[c[i] for i in sorted(c)] for c in classes], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["y", "tokens", "best", "classes", "counts"])

    seen = texts.mapInArrow(scanned, "y int, tokens long, best double, classes array<long>, counts array<long>").toArrow().to_pylist()
    seen.sort(key=lambda r: (r["y"], r["tokens"], r["classes"], r["counts"]))
    plain = [r for r in seen if r["y"] == 0]
    # Mean of the best sum less its growth with length, over clean texts that have a segment: moments of the law.
    best = [model.rate * r["best"] - log(r["tokens"]) for r in plain if r["best"] is not None]
    if best:
        model.constant = min(1.0, max(1e-4, exp(float(np.mean(best)) - _EULER)))
        of_class = Counter()
        for r in plain:
            of_class.update(dict(zip(r["classes"], r["counts"])))
        counts = np.array([of_class[i] for i in range(max(of_class) + 2)], float)  # none in the last
        with np.errstate(divide="ignore"):
            model.common = np.log(counts[::-1].cumsum()[::-1] / sum(r["tokens"] for r in plain))
    x = [min(model.evidence(r["tokens"], [(0, 0, (i + 0.5) * _STEP) for i, n in zip(r["classes"], r["counts"]) for _ in range(n)])[0], 50.0) for r in seen]
    model.slope, model.offset = _logistic(np.array(x, float), np.array([r["y"] for r in seen], float))
    # Without any evidence a text is never rejected, whatever the share of toxic labels.
    least = settings.threshold * 2 / 3
    model.offset = min(model.offset, log(least / (1 - least)))
    return model


def _rate(shares: np.ndarray, steps: np.ndarray) -> float:
    """The positive root of sum p exp(rate * s) = 1, for steps that fall on average; within 0.05 and 1, the rate of exact log-odds."""
    low, high = 0.05, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if (shares * np.exp(middle * steps)).sum() > 1 else (middle, high)
    return low


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (never negative) and offset by Newton steps, both labels being seen one more time at no evidence."""
    x, y = np.append(x, [0.0, 0.0]), np.append(y, [0.0, 1.0])
    columns = np.stack([x, np.ones_like(x)], axis=1)
    weights = np.array([0.0, log(y.mean() / (1 - y.mean()))])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(columns @ weights, -30, 30)))
        slope = columns.T @ (p - y) + 1e-2 * weights * [1, 0]
        bend = (columns * (p * (1 - p))[:, None]).T @ columns + np.diag([1e-2, 1e-6])
        weights = weights - np.clip(np.linalg.solve(bend, slope), -2, 2)
    return max(0.0, float(weights[0])), float(weights[1])


def _scores(texts: Iterable[str | None], model: ToxicityModel, scores: TokenScores) -> list[float]:
    return [model.probability(model.evidence(*model.scan(text, scores))[0]) for text in texts]


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted and the significant passages (token ranges with their sums) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("sum", pa.float64())]))

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scores = TokenScores(model.words, model.classes, model.settings)
        for batch in in_slices(batches):
            found = [model.evidence(*model.scan(text, scores)) for text in batch.column("text").to_pylist()]
            spans = [[{"start": s, "end": e, "sum": x} for s, e, x in p] for _, p in found]
            columns = [batch.column("doc_id"), pa.array([model.probability(e) for e, _ in found], pa.float64()), pa.array(spans, passage)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "passages"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    types = f"doc_id {id_type}, score double, passages array<struct<start:int,end:int,sum:double>>"
    found = docs.select("doc_id", "text").mapInArrow(scored, types)
    predicted = (F.col("score") >= model.settings.threshold).cast("int")
    return found.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"), "passages")


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def passed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scores = TokenScores(model.words, model.classes, model.settings)
        for batch in in_slices(batches):
            found = _scores(batch.column("text").to_pylist(), model, scores)
            yield batch.filter(pa.array([s < model.settings.threshold for s in found], pa.bool_()))

    return docs.mapInArrow(passed, docs.schema)
