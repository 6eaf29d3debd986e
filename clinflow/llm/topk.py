"""Exact top-k search by integer inner product: a ball tree per shard, branch and bound, the kth score shared.

Vectors are dealt to shards by nearness: planes cut a bounded sample in halves of halves, and every vector goes where the
planes send it; a part that holds more than its share (many alike vectors) is cut by hash. Each shard reports its ball. A
query is first searched in the shard of best centre; its kth score there then goes with it to those other shards alone whose
upper bound q.c + |q| r reaches it. So vectors travel once, and once more per block of queries only where more than a block
of them comes to a shard.

One task searches one shard for one block: it builds the shard's ball tree and walks it for all queries together, nodes in the
order of their bounds; a query drops out of a node whose bound is below its kth score, and a leaf is scored for those left by
one matrix product. All scores are exact integers.

Pruning lives on structure. Vectors that point everywhere alike in many dimensions have none: then every bound is above every kth
score and all vectors are scored, by matrix products.

Defined results: vectors that are NULL, hold NULL or a component that is not finite times the scale, or have no vec_id,
take no part. Only vectors of the same number of components meet; no components score zero. Of rows that repeat
the vec_id of a query the greatest vector asks, once; rows with that vec_id are its own and no candidates. Other
repeated rows are candidates each. Scores beyond a long are held at its ends before they
are compared. Fewer candidates give fewer rows, an empty table none. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil, floor

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from clinflow.scratch import materialize

_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class SearchSettings:
    """``shard``: vectors a shard aims at; ``block``: queries one task takes; ``leaf``: vectors of a leaf; ``sample``: numbers
    in the sample of vectors that the planes are laid through; ``ball_bytes``: what the balls of all shards may take, if need
    be by larger shards."""

    k: int = 5
    scale: int = 256
    shard: int = 8192
    block: int = 4096
    leaf: int = 64
    sample: int = 1 << 20
    ball_bytes: int = 32 << 20


def usable(vector: Column, scale: int) -> Column:
    """Every component is there and finite, also after scaling."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(1.7e308 / scale)))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def quantised(vectors: Sequence, scale: int) -> np.ndarray:
    """floor(scale * x) of every component: longs where products of such vectors fit, else Python integers."""
    scaled = np.floor(np.array([np.asarray(v, float) for v in vectors]).reshape(len(vectors), -1) * scale)
    width = max(1, scaled.shape[1])
    if not scaled.size or np.abs(scaled).max() < (2.0**62 / width) ** 0.5:
        return scaled.astype(np.int64)
    out = np.empty(scaled.shape, object)
    out[:] = [[floor(x) for x in row] for row in scaled.tolist()]
    return out


class BallTree:
    """Balls around halves of halves of the rows, down to leaves."""

    def __init__(self, rows: np.ndarray, leaf: int):
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self.children: list[tuple[int, int] | None] = []
        self.members: list[np.ndarray] = []
        if len(rows):
            self._build(rows.astype(float), np.arange(len(rows)), leaf)
        self.centre = np.array(self.centres)
        self.radius = np.array(self.radii)

    def _build(self, rows: np.ndarray, members: np.ndarray, leaf: int) -> int:
        node = len(self.radii)
        own = rows[members]
        centre = own.mean(axis=0)
        with np.errstate(all="ignore"):  # huge components give infinite radii, which never prune
            away = np.nan_to_num(np.linalg.norm(own - centre, axis=1), nan=np.inf)
        self.centres.append(centre)
        self.radii.append(float(away.max()))
        self.children.append(None)
        self.members.append(members)
        if len(members) > leaf:
            # Along the line from the farthest row to the row farthest from that: between the two, so that groups stay
            # whole, or in halves of equal size where that would leave nearly all rows on one side.
            one = own[away.argmax()]
            with np.errstate(all="ignore"):
                other = own[np.linalg.norm(own - one, axis=1).argmax()]
                along = np.nan_to_num(own @ (other - one))
                between = np.nan_to_num((one + other) @ (other - one) / 2)
            side = np.argsort(along, kind="stable")
            cut = int((along < between).sum())
            if min(cut, len(members) - cut) < len(members) // 10 + 1:
                cut = len(members) // 2
            self.children[node] = (self._build(rows, members[side[:cut]], leaf), self._build(rows, members[side[cut:]], leaf))
        return node

    def search(self, rows: np.ndarray, ids: np.ndarray, found: Best, queries: np.ndarray) -> int:
        """Take in the best rows for all queries together; how many rows were scored, summed over the queries."""
        scored = 0
        todo = [(0, np.arange(len(queries)))] if len(ids) else []
        asked = queries.astype(float)
        with np.errstate(all="ignore"):
            sizes = np.linalg.norm(asked, axis=1)
        while todo:
            node, active = todo.pop()
            active = active[self.reach(node, asked[active], sizes[active]) >= found.floor[active]]
            if not len(active):
                continue
            if self.children[node] is None:
                members = self.members[node]
                scored += len(members) * len(active)
                found.take(active, products(queries[active], rows[members]), ids[members])
                continue
            # The child that promises more on the whole comes next, so it goes on the stack last.
            order = sorted(self.children[node], key=lambda c: float(np.mean(self.reach(c, asked[active], sizes[active]))))
            todo += [(child, active) for child in order]
        return scored

    def reach(self, node: int, asked: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return upper_bounds(asked, sizes, self.centre[node : node + 1], self.radius[node : node + 1])[:, 0]


def upper_bounds(asked: np.ndarray, sizes: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Per query and ball what no vector of the ball scores above; a little is added for rounding."""
    with np.errstate(all="ignore"):
        found = asked @ centres.T + sizes[:, None] * radii
        slack = 1e-9 * sizes[:, None] * (np.linalg.norm(centres, axis=1) + radii) + 1e-6
        return np.maximum(np.nan_to_num(found + slack, nan=np.inf), -_LONG - 1)


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products as longs, held at the ends of a long."""
    if queries.dtype == object or rows.dtype == object:
        exact = queries.astype(object) @ rows.T.astype(object) if queries.shape[1] else np.zeros((len(queries), len(rows)), object)
        return np.array([[max(-_LONG - 1, min(_LONG, int(x))) for x in row] for row in exact], np.int64).reshape(exact.shape)
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, queries.shape[1])
    if most < 2.0**53:  # doubles hold every partial sum exactly
        return (queries.astype(float) @ rows.T.astype(float)).astype(np.int64)
    return queries @ rows.T


class Best:
    """The best k of each query so far, and the score that a row must reach to matter."""

    def __init__(self, own: np.ndarray, least: np.ndarray, k: int):
        self.own, self.k = own, k
        self.scores = np.zeros((len(own), k), np.int64)
        self.ids = np.zeros((len(own), k), np.int64)
        self.filled = np.zeros((len(own), k), bool)
        self.floor = least.copy()

    def take(self, active: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        good = (scores >= self.floor[active][:, None]) & (ids != self.own[active][:, None])
        some = good.any(axis=1)
        if not some.any():
            return
        at = active[some]
        all_scores = np.concatenate([self.scores[at], scores[some]], axis=1)
        all_ids = np.concatenate([self.ids[at], np.broadcast_to(ids, (len(at), len(ids)))], axis=1)
        there = np.concatenate([self.filled[at], good[some]], axis=1)
        order = np.lexsort((all_ids, ~all_scores, ~there), axis=1)[:, : self.k]
        self.scores[at], self.ids[at], self.filled[at] = (np.take_along_axis(x, order, 1) for x in (all_scores, all_ids, there))
        full = self.filled[at].all(axis=1)
        self.floor[at[full]] = np.maximum(self.floor[at[full]], self.scores[at[full], -1])

    def rows(self) -> pd.DataFrame:
        query, place = np.nonzero(self.filled)
        return pd.DataFrame({"query_id": self.own[query], "vec_id": self.ids[query, place], "score": self.scores[query, place]})


class Planes:
    """Cuts of a sample in halves of halves, which send any vector to one of the parts."""

    def __init__(self, sample: np.ndarray, parts: int):
        self.nodes: list[tuple[np.ndarray, float, int, int] | int] = []
        self.parts = 0
        self._cut(sample, np.arange(len(sample)), parts)

    def _cut(self, sample: np.ndarray, members: np.ndarray, parts: int) -> int:
        node = len(self.nodes)
        self.nodes.append(self.parts)
        own = sample[members]
        if parts > 1 and len(members) > 1:
            one = own[np.linalg.norm(own - own.mean(axis=0), axis=1).argmax()]
            other = own[np.linalg.norm(own - one, axis=1).argmax()]
            along = own @ (other - one)
            # A share of the parts on either side, as of the members.
            half = float(np.quantile(along, (parts // 2) / parts))
            left = along < half
            if left.any():
                low = self._cut(sample, members[left], parts // 2)
                self.nodes[node] = (other - one, half, low, self._cut(sample, members[~left], parts - parts // 2))
                return node
        self.parts += 1
        return node

    def part(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.int32)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, members = todo.pop()
            cut = self.nodes[node]
            if isinstance(cut, int):
                out[members] = cut
                continue
            direction, half, low, high = cut
            left = rows[members] @ direction < half
            todo += [(low, members[left]), (high, members[~left])]
        return out


def _stacked(vectors: Sequence) -> np.ndarray:
    """Vectors as doubles, so far from their ends that sums of squares stay finite; only the layout looks at these."""
    if not len(vectors):
        return np.zeros((0, 0))
    return np.clip(np.array([np.asarray(v, float) for v in vectors]).reshape(len(vectors), -1), -1e100, 1e100)


def _dealt(rows: DataFrame, settings: SearchSettings) -> tuple[DataFrame, int, int]:
    """(``rows`` with ``shard``, the width most of them have, shards of all other widths).

    Shards of the main width are 0 and up and hold near vectors; those of others are negative and dealt by hash.
    """
    session = rows.sparkSession
    widths = rows.groupBy("width").count()
    main = widths.orderBy(F.desc("count"), "width").first()
    width, count = (main["width"], main["count"]) if main else (0, 0)
    others = widths.filter(F.col("width") != width).agg(F.sum("count").alias("n")).first()["n"] or 0
    other_shards = ceil(others / settings.shard)
    mark = F.xxhash64("vec_id", "number")
    numbers = max(1, width)
    shards = max(1, min(ceil(count / settings.shard), settings.ball_bytes // (8 * (numbers + 4))))
    mine = rows.filter(F.col("width") == width)
    taken = mine.orderBy(mark).limit(max(16, min(count, settings.sample // numbers))).select("embedding").toPandas()
    planes = Planes(_stacked(taken["embedding"]), min(shards, max(1, len(taken) // 8)))
    # What hangs on a plane's cut is dealt anew by every reader, so the outcome is stored.
    sent = session.sparkContext.broadcast(planes)

    def parted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(part=sent.value.part(_stacked(batch["embedding"])) if len(batch) else np.int32(0))

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    placed = materialize(mine.mapInPandas(parted, f"{types}, part int"), "parts")
    sizes = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}  # one row per part
    cuts = [max(1, ceil(sizes.get(part, 0) * shards / max(1, count) / 2)) for part in range(planes.parts)]
    starts = [sum(cuts[:part]) for part in range(planes.parts)]
    cut, start = (F.element_at(F.array(*map(F.lit, values)), F.col("part") + 1) for values in (cuts, starts))
    near = placed.withColumn("shard", (start + F.pmod(mark, cut)).cast("int")).drop("part")
    far = rows.filter(F.col("width") != width)
    far = far.withColumn("shard", (-1 - F.pmod(mark, F.lit(max(1, other_shards)))).cast("int"))
    return materialize(near.unionByName(far), "shards"), width, other_shards


def _balls(held: DataFrame, settings: SearchSettings) -> pd.DataFrame:
    """(shard, centre, radius) of the shards of the main width; their number is bounded by ``ball_bytes``."""

    def ball(rows: pd.DataFrame) -> pd.DataFrame:
        own = quantised(rows["embedding"], settings.scale).astype(float)
        with np.errstate(all="ignore"):
            centre = own.mean(axis=0)
            radius = float(np.nan_to_num(np.linalg.norm(own - centre, axis=1), nan=np.inf).max())
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "centre": [centre.tolist()], "radius": [radius]})

    found = held.filter(F.col("shard") >= 0).select("shard", "embedding")
    return found.groupBy("shard").applyInPandas(ball, "shard int, centre array<double>, radius double").toPandas().sort_values("shard")


def _sent(queries: DataFrame, balls: pd.DataFrame, settings: SearchSettings, first: bool) -> DataFrame:
    """``queries`` (of the main width) once per shard to search: the one of best centre, or the others their kth score lets in."""
    if balls.empty:
        return queries.withColumn("shard", F.lit(0)).limit(0)
    held = queries.sparkSession.sparkContext.broadcast(
        (balls["shard"].to_numpy(), np.array(balls["centre"].tolist()).reshape(len(balls), -1), balls["radius"].to_numpy())
    )

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shards, centres, radii = held.value
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.iloc[at : at + 256]
                asked = quantised(batch["embedding"], settings.scale).astype(float)
                with np.errstate(all="ignore"):
                    best = np.argmax(np.nan_to_num(asked @ centres.T), axis=1)
                    if first:
                        yield batch.assign(shard=shards[best].astype(np.int32))
                        continue
                    bounds = upper_bounds(asked, np.linalg.norm(asked, axis=1), centres, radii)
                wanted = bounds >= batch["least"].fillna(-_LONG - 1).to_numpy(float)[:, None] * (1 - 1e-12) - 1
                wanted[np.arange(len(batch)), best] = False
                query, shard = np.nonzero(wanted)
                yield batch.iloc[query].assign(shard=shards[shard].astype(np.int32))

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.schema)
    return queries.mapInPandas(each, f"{types}, shard int")


def _searched(queries: DataFrame, held: DataFrame, settings: SearchSettings) -> DataFrame:
    """(query_id, vec_id, score): per query and shard it is sent to the best k at or above its ``least``."""
    asked = materialize(queries, "sent")
    # Only where more queries than a block come to a shard is it there once per block.
    crowded = asked.groupBy("shard").count().withColumn("blocks", F.ceil(F.col("count") / settings.block).cast("int"))
    crowded = materialize(crowded.select("shard", "blocks"), "blocks")
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    asked = asked.join(crowded, "shard").withColumn("block", block).drop("blocks")
    vectors = held.join(crowded, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def cell(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        both = quantised([*asked["embedding"], *held["embedding"]], settings.scale)
        mine, rows = both[: len(asked)], both[len(asked) :]
        least = np.array([-_LONG - 1 if pd.isna(x) else int(x) for x in asked["least"].tolist()], np.int64)
        found = Best(asked["vec_id"].to_numpy(np.int64), least, settings.k)
        BallTree(rows, settings.leaf).search(rows, held["vec_id"].to_numpy(np.int64), found, mine)
        return found.rows()

    on = ["shard", "block", "width"]
    given = vectors.select("vec_id", "embedding", *on)
    return asked.groupBy(*on).cogroup(given.groupBy(*on)).applyInPandas(cell, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, settings: SearchSettings = SearchSettings()) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` picks, its best k other rows, ties to smaller ids."""
    usable_rows = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"), settings.scale))
    rows = usable_rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.size("embedding").alias("width"), is_query.alias("asks"))
    # Rows of one vec_id must not share a shard for their number, so a number of their own counts too; stored, since
    # the vectors are read several times.
    rows = materialize(rows.withColumn("number", F.monotonically_increasing_id()), "vectors")
    held, width, other_shards = _dealt(rows, settings)
    balls = _balls(held, settings)
    asking = rows.filter(F.col("asks")).groupBy("vec_id").agg(F.max(F.struct("embedding", "width")).alias("asked"))
    unknown = F.lit(None).cast("long").alias("least")
    asking = materialize(asking.select("vec_id", "asked.embedding", "asked.width", unknown), "queries")
    mine = asking.filter(F.col("width") == width)
    found = materialize(_searched(_sent(mine, balls, settings, True), held, settings), "first-shard")
    if len(balls) > 1:
        full = F.when(F.count(F.lit(1)) >= settings.k, F.min("score")).alias("least")
        bounds = found.groupBy(F.col("query_id").alias("vec_id")).agg(full)
        bounded = mine.drop("least").join(bounds, "vec_id", "left").select("vec_id", "embedding", "width", "least")
        found = found.unionByName(_searched(_sent(bounded, balls, settings, False), held, settings))
    if other_shards:
        each = asking.filter(F.col("width") != width).withColumn("shard", F.explode(F.sequence(F.lit(-other_shards), F.lit(-1))))
        found = found.unionByName(_searched(each, held, settings))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= settings.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
