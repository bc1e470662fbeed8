"""Approximate nearest neighbours by learned partitions.

On a bounded sample the exact neighbour graph is cut into balanced parts that keep neighbours together,
and a small network learns which parts a vector's neighbours lie in. Every vector is indexed under its most
probable part. A query goes to its most probable parts until they hold a set share of the probability, and what it
finds there is ranked by the exact inner product. The share is measured: a few hundred vectors, none of which
was learned from where there are enough others, are searched exactly in the whole table, and the least share
counts that finds as many of their true neighbours as is aimed at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.common import checkpointed
from ledgerfold.llm.neighbours import points, to_rows

#: The index is fitted on at most so many distinct vectors, those of least hash; all are indexed.
SAMPLE = 8192
#: Neighbours of each vector in the graph, parts at most, and how much a part may exceed the mean.
DEGREE, MOST_PARTS, SLACK = 10, 1024, 1.1
#: Units of the hidden layer, training steps and batch.
HIDDEN, STEPS, BATCH = 64, 400, 256
#: Recall that the share of probability must give on so many vectors that are searched exactly in the whole table.
AIM, ASKED = 0.95, 256
#: Vectors of a part that are searched in one task, and queries that visit them together.
BLOCK, VISITORS = 16_384, 4_096


@dataclass(frozen=True)
class Router:
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    share: float

    @property
    def parts(self) -> int:
        return len(self.b2)

    def chances(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum(unit(x) @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def routes(self, x: np.ndarray, rows: np.ndarray, least: int) -> list[np.ndarray]:
        """Parts to visit: the most probable ones until they hold the share, and at least so many ``rows``."""
        p = self.chances(x)
        order = np.argsort(-p, axis=1, kind="stable")
        held = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1)
        few = np.cumsum(rows[order], axis=1) < least
        n = np.minimum(np.maximum((held < self.share).sum(axis=1), few.sum(axis=1)) + 1, self.parts)
        return [o[:m] for o, m in zip(order, n, strict=True)]


def unit(x: np.ndarray) -> np.ndarray:
    """Scaled to length 1, so that routing does not depend on a vector's length."""
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """Exact nearest others of each row by inner product, in blocks."""
    out = np.empty((len(x), degree), dtype=np.int64)
    for at in range(0, len(x), 1024):
        s = x[at : at + 1024] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at : at + 1024] = np.argpartition(-s, degree - 1, axis=1)[:, :degree]
    return out


def balanced(wish: np.ndarray, most: int) -> np.ndarray:
    """Rows to parts by strength of wish, strongest first, no part above ``most``."""
    n, parts = wish.shape
    label, room = np.full(n, -1), np.full(parts, most)
    order = np.argsort(-wish, axis=1, kind="stable")
    for choice in range(parts):
        open_rows = np.flatnonzero(label < 0)
        if not len(open_rows):
            break
        want = order[open_rows, choice]
        rank = np.lexsort((-wish[open_rows, want], want))
        rows, want = open_rows[rank], want[rank]
        nth = np.arange(len(want)) - np.searchsorted(want, want)
        ok = nth < room[want]
        label[rows[ok]] = want[ok]
        room -= np.bincount(want[ok], minlength=parts)
    return label


def cut_graph(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Balanced parts: balanced k-means to begin with, then rows follow their neighbours' parts while
    there is room."""
    most = int(np.ceil(SLACK * len(x) / parts))
    centres = x[rng.choice(len(x), parts, replace=False)]
    for _ in range(8):
        label = balanced(x @ centres.T, most)
        sums = np.zeros_like(centres)
        np.add.at(sums, label, x)
        centres = unit(sums + 1e-9)
    for _ in range(8):
        votes = np.zeros((len(x), parts), dtype=np.float32)
        rows = np.repeat(np.arange(len(x)), graph.shape[1])
        np.add.at(votes, (rows, label[graph].ravel()), 1.0)
        np.add.at(votes, (graph.ravel(), np.repeat(label, graph.shape[1])), 1.0)
        votes[np.arange(len(x)), label] += 0.5
        label = balanced(votes + 1e-3 * (x @ centres.T), most)
    return label


def fit_router(sample: np.ndarray, parts: int, seed: int = 11) -> Router:
    """Partition the sample and learn to route."""
    rng = np.random.default_rng(seed)
    x = unit(sample)
    n, d = x.shape
    parts = max(1, min(parts, n // (2 * DEGREE)))
    if parts == 1:
        zero = np.zeros
        return Router(zero((d, 1), np.float32), zero(1, np.float32), zero((1, 1), np.float32), zero(1, np.float32), 1.0)
    graph = neighbour_graph(x, DEGREE)
    label = cut_graph(x, graph, parts, rng)
    # a row's aim: its own part and those of its neighbours
    aim = np.zeros((n, parts), dtype=np.float32)
    np.add.at(aim, (np.repeat(np.arange(n), DEGREE), label[graph].ravel()), 1.0)
    aim[np.arange(n), label] += DEGREE / 2
    aim /= aim.sum(axis=1, keepdims=True)
    net = [rng.normal(0, d**-0.5, (d, HIDDEN)) * 2, np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, (HIDDEN, parts)), np.zeros(parts)]
    net = [w.astype(np.float32) for w in net]
    first, second = [np.zeros_like(w) for w in net], [np.zeros_like(w) for w in net]
    for step in range(1, STEPS + 1):
        i = rng.integers(0, n, BATCH)
        h = np.maximum(x[i] @ net[0] + net[1], 0)
        z = h @ net[2] + net[3]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        dz = (p - aim[i]) / BATCH
        dh = (dz @ net[2].T) * (h > 0)
        for w, g, m, v in zip(net, [x[i].T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0)], first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Router(*net, 1.0)


def least_share(router: Router, vectors: np.ndarray, asked: np.ndarray, part: np.ndarray) -> float:
    """The least share of probability with which queries reach AIM of their true neighbours: ``part`` is where the one of
    each row of ``asked`` (places among ``vectors``) lies."""
    if not len(asked):
        return 1.0
    p = router.chances(vectors)
    order = np.argsort(-p, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1) - np.take_along_axis(p, order, axis=1)
    at = np.argsort(order, axis=1)[asked, part]
    return min(1.0, float(np.quantile(before[asked, at], AIM)) + 1e-6)


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def search_part(vectors: np.ndarray, first: np.ndarray, queries: np.ndarray, k: int):
    """Places and scores of each query's ``k + 1`` best rows, ties to the least first id. Candidates come from
    a matrix product; those that may belong are scored again term by term, so equal vectors score alike."""
    for at in range(0, len(queries), 256):
        q = queries[at : at + 256]
        rough = q @ vectors.T
        if len(vectors) > k + 1:
            least = np.partition(rough, len(vectors) - k - 1, axis=1)[:, len(vectors) - k - 1]
        else:
            least = np.full(len(q), -np.inf)
        margin = 1e-9 * (1 + np.abs(rough).max(axis=1))
        who, place = np.nonzero(rough >= (least - margin)[:, None])
        score = (q[who] * vectors[place]).sum(axis=1)
        sort = np.lexsort((first[place], -score, who))
        who, place, score = who[sort], place[sort], score[sort]
        keep = np.arange(len(who)) - np.searchsorted(who, who) < k + 1
        yield who[keep] + at, place[keep], score[keep]


def neighbours_of_asked(placed: DataFrame, asked: np.ndarray, points_asked: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(place of the query, part)`` of the k true neighbours of each asked vector in the whole table, which is read once."""

    def best(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            score = asked @ np.stack(part["vector"]).T
            score[np.array(points_asked)[:, None] == part["point"].to_numpy()[None, :]] = -np.inf  # not itself
            n = min(k, score.shape[1])
            at = np.argpartition(-score, n - 1, axis=1)[:, :n]
            q = np.repeat(np.arange(len(asked)), n)
            rows = pd.DataFrame({"q": q, "score": np.take_along_axis(score, at, axis=1).ravel(), "part": part["part"].to_numpy()[at.ravel()]})
            yield rows[np.isfinite(rows["score"])]

    near = placed.select("point", "vector", "part").mapInPandas(best, "q int, score double, part int")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "part")
    top = near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k).select("q", "part").toPandas()  # ASKED * k rows
    return top["q"].to_numpy(), top["part"].to_numpy()


def measured(router: Router, placed: DataFrame, k: int) -> Router:
    """The router with the share that finds the true neighbours of the vectors of greatest hash; the sample has those of least."""
    if router.parts == 1:
        return router
    rows = placed.orderBy(F.desc("point"), "first_id").limit(ASKED).select("point", "vector").toPandas()
    vectors = np.stack(rows["vector"])
    return replace(router, share=least_share(router, vectors, *neighbours_of_asked(placed, vectors, rows["point"].tolist(), k)))


def nearest_vectors(
    rows: DataFrame, queries: Column, k: int = 20, parts: int | None = None, row_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank``, ``id`` and ``score``: for each row that ``queries`` selects, the ``k`` rows of largest
    inner product that its parts hold, in double precision, ties to the smaller id.

    Rows without an id, and vectors that are null, zero, hold null or non-finite components or have
    another length than most, take no part. Rows with equal id and vector are one; rows of one id never
    find each other. ``parts`` is a quarter of the root of the number of distinct vectors unless stated, at
    most MOST_PARTS; with few rows it comes to one and the search is exact. Other columns are not used.
    """
    given = rows.select(
        F.col(row_id).alias("id"), F.col(vector).cast("array<double>").alias("vector"), queries.alias("asks")
    ).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    common = given.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
    given = given.filter(F.size("vector") == common["d"])
    point = F.xxhash64("vector", "first_id")
    index = checkpointed(points(given.select("id", "vector"), "vector", k).withColumn("point", point))
    n = index.count()
    sample = index.orderBy("point", "first_id").limit(SAMPLE).select("vector").toPandas()["vector"]
    router = fit_router(np.stack(sample), parts or min(MOST_PARTS, max(1, round(n**0.5 / 4))))

    learned = router

    @F.pandas_udf("int")
    def part_of(v: pd.Series) -> pd.Series:
        return pd.Series(learned.chances(np.stack(v)).argmax(axis=1) if len(v) else [], dtype="int32")

    key = ["first_id", "point"]
    placed = checkpointed(index.select(*key, "n_ids", "vector", part_of("vector").alias("part")))
    router = measured(router, placed, k)
    held = np.zeros(router.parts, dtype=np.int64)  # distinct vectors of each part
    for part in placed.groupBy("part").count().collect():
        held[part["part"]] = part["count"]

    @F.pandas_udf("array<int>")
    def parts_of(v: pd.Series) -> pd.Series:
        return pd.Series(router.routes(np.stack(v), held, k + 1) if len(v) else [], dtype=object)

    asked = given.filter("asks").select(F.col("id").alias("query_id"), "vector").distinct()
    named = asked.join(index.select("vector", *key), "vector").select(
        "query_id", F.col("first_id").alias("q_first_id"), F.col("point").alias("q_point"), F.col("vector").alias("q_vector")
    )
    named = checkpointed(named)
    wanted = named.select("q_first_id", "q_point", "q_vector").dropDuplicates(["q_first_id", "q_point"])
    visits = checkpointed(wanted.withColumn("part", F.explode(parts_of("q_vector"))))
    # one row per part: how many blocks its vectors and its visitors make
    sizes = placed.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    crowds = visits.groupBy("part").agg(F.ceil(F.count("*") / VISITORS).cast("int").alias("groups"))
    shape = F.broadcast(sizes.join(crowds, "part"))  # at most MOST_PARTS rows
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    dealt = placed.join(shape, "part").select(
        "part", *key, "vector", F.pmod("point", "blocks").cast("int").alias("block"), every("groups").alias("group")
    )
    sent = visits.join(shape, "part").select(
        "part", "q_first_id", "q_point", "q_vector", F.pmod("q_point", "groups").cast("int").alias("group"), every("blocks").alias("block")
    )
    schema = "q_first_id long, q_point long, first_id long, point long, score double"

    def search(here: pd.DataFrame, mine: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(here) and len(mine):
            x, q = np.stack(here["vector"]), np.stack(mine["q_vector"])
            ids, uid = here["first_id"].to_numpy(), here["point"].to_numpy()
            for i, j, s in search_part(x, ids, q, k):
                found.append(pd.DataFrame({
                    "q_first_id": mine["q_first_id"].to_numpy()[i], "q_point": mine["q_point"].to_numpy()[i],
                    "first_id": ids[j], "point": uid[j], "score": s,
                }))
        empty = {c.split(" ")[0]: pd.Series(dtype=c.split(" ")[1].replace("long", "int64").replace("double", "float64")) for c in schema.split(", ")}
        return pd.concat(found) if found else pd.DataFrame(empty)

    near = dealt.groupBy("part", "block", "group").cogroup(sent.groupBy("part", "block", "group")).applyInPandas(search, schema)
    ranked = Window.partitionBy("q_first_id", "q_point").orderBy(F.desc("score"), "first_id")
    best = near.withColumn("n", F.row_number().over(ranked)).filter(F.col("n") <= k + 1).drop("n")
    return to_rows(best, index, named.drop("q_vector"), key, "score", F.desc("score"), k)
