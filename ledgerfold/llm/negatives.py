"""Hard negatives of anchors, found by rotated one-bit codes and confirmed by integer scores.

Every vector is turned by one fixed random rotation and kept as the signs of its coordinates, with its length and
the cosine between the vector and its own sign code (the alignment). The inner product of a query with a code comes from
popcounts on the bit planes of the query. A unit vector is its alignment times its code and a residual at right angles
to the code, and the residual's product with the query is at most the residual's length times the length of what the query has
beside the code (Cauchy-Schwarz). So every estimate has an interval that always holds the true product. Rows whose interval
rules them out are left; the others are scored exactly in integers. Nothing is lost: the filter is never wrong, only wide.

Rows are dealt into blocks and anchors into parts; every part meets every block, and a meeting hands on a few rows per anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.common import checkpointed

#: Rows of a block, anchors of a part, anchors looked at side by side.
BLOCK, PART, SIDE_BY_SIDE = 8_192, 4_096, 32
#: Bits of a query's coordinates, and seed of the rotation.
PLANES, SEED = 8, 12
#: Share of a score's largest value that rounding may cost.
ROUNDING = 1e-9
INDEX = "id long, label long, dims int, vector binary, code binary, norm double, align double"


@lru_cache(maxsize=4)
def rotation(dims: int) -> np.ndarray:
    """An orthogonal matrix of a multiple of 64 rows, the same everywhere."""
    wide = max(64, -(-dims // 64) * 64)
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(wide, wide)))
    return q * np.sign(np.diag(r))


def turned(x: np.ndarray) -> np.ndarray:
    """Rows, filled up with zeros, in the rotated frame."""
    turn = rotation(x.shape[1])
    return x @ turn[: x.shape[1]]


def coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(codes, norms, alignments)`` of the rows: sign bits as 64-bit words, lengths, cosines with the code."""
    norm = np.linalg.norm(x, axis=1)
    z = turned(x / np.maximum(norm, 1e-300)[:, None])
    codes = np.packbits(z > 0, axis=1, bitorder="little").view(np.uint64)
    return codes, norm, np.abs(z).sum(axis=1) / np.sqrt(z.shape[1])


def intervals(codes: np.ndarray, norm: np.ndarray, align: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each coded row with a query."""
    z = turned(query[None, :])[0]
    wide, length = len(z), float(np.linalg.norm(query))
    low = z.min()
    step = (z.max() - low) / (2**PLANES - 1) or 1.0
    level = np.rint((z - low) / step).astype(np.uint16)
    missed = np.abs(z - (low + step * level)).sum()
    inside = low * np.bitwise_count(codes).sum(axis=1, dtype=np.int64).astype(float)
    for bit in range(PLANES):
        plane = np.packbits((level >> bit) & 1, bitorder="little").view(np.uint64)
        inside += step * 2.0**bit * np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int64)
    along = (2 * inside - (low + step * level).sum()) / np.sqrt(wide)  # query times code, but for what its levels missed
    off = missed / np.sqrt(wide)
    least = np.maximum(np.abs(along) - off, 0.0)
    beside = np.sqrt(np.maximum(length**2 - least**2, 0.0))
    half = align * off + np.sqrt(np.maximum(1.0 - align**2, 0.0)) * beside + ROUNDING * (1 + length)
    return norm * (align * along - half) - ROUNDING, norm * (align * along + half) + ROUNDING


def products(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers with one."""
    most = np.abs(x).max(initial=0.0) * np.abs(query).max(initial=0.0) * max(1, x.shape[1])
    if most < 2**53:
        return (x @ query).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(row, query, strict=True)) for row in x]
    if any(abs(s) >= 2**56 for s in exact):
        raise ValueError("integer scores of these vectors don't fit 64 bits")
    return np.array(exact, dtype=np.int64)


class Block:
    """Coded rows that a task holds."""

    def __init__(self, rows: pd.DataFrame):
        dims = int(rows["dims"].iloc[0])
        self.ids, self.labels = rows["id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
        self.x = np.frombuffer(b"".join(rows["vector"]), dtype=np.float64).reshape(len(rows), dims)
        self.codes = np.frombuffer(b"".join(rows["code"]), dtype=np.uint64).reshape(len(rows), -1)
        self.norm, self.align = rows["norm"].to_numpy(float), rows["align"].to_numpy(float)

    def bounds(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return intervals(self.codes, self.norm, self.align, query)

    def first(self, rows: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """Places among ``rows`` of the k highest scores, ties to the smaller id."""
        return np.lexsort((self.ids[rows], -score))[:k]


def _least_of_best(low: np.ndarray, k: int) -> float:
    """What the k-th best surely reaches."""
    return np.partition(low, len(low) - k)[len(low) - k] if len(low) >= k else -np.inf


def nearest_alike(block: Block, anchors: pd.DataFrame, k: int) -> Iterator[tuple[int, int, int]]:
    """``(anchor, id, score)`` of each anchor's k best rows of its label in the block; other ids only."""
    for at, (me, label, raw) in enumerate(zip(anchors["id"], anchors["label"], anchors["vector"], strict=True)):
        query = np.frombuffer(raw, dtype=np.float64)
        mine = np.flatnonzero((block.labels == label) & (block.ids != me))
        low, high = (b[mine] for b in block.bounds(query))
        mine = mine[high >= _least_of_best(low, k)]
        score = products(block.x[mine], query)
        for i in block.first(mine, score, k):
            yield at, int(block.ids[mine[i]]), int(score[i])


def nearest_others(block: Block, anchors: pd.DataFrame, k: int, least: int, most: int) -> Iterator[tuple[int, int, int, int]]:
    """``(anchor, place of the positive, id, score)`` of each positive's k best rows of other labels whose score is
    between ``least`` and ``most`` hundredths of the positive's."""
    named = zip(anchors["id"], anchors["label"], anchors["vector"], anchors["positive_scores"], strict=True)
    for at, (me, label, raw, positives) in enumerate(named):
        query = np.frombuffer(raw, dtype=np.float64)
        others = np.flatnonzero((block.labels != label) & (block.ids != me))
        low, high = (b[others] for b in block.bounds(query))
        may = np.zeros(len(others), dtype=bool)
        for p in set(map(int, positives)):
            floor, ceiling = least * p / 100, most * p / 100
            slack = ROUNDING * (1 + abs(floor) + abs(ceiling))
            met = (high >= floor - slack) & (low <= ceiling + slack)
            sure = (low >= floor + slack) & (high <= ceiling - slack)
            may |= met & (high >= _least_of_best(low[sure], k))
        others = others[may]
        score = products(block.x[others], query)
        for n, p in enumerate(map(int, positives)):
            fits = np.flatnonzero((least * p <= 100 * score) & (100 * score <= most * p))
            for i in block.first(others[fits], score[fits], k):
                yield at, n, int(block.ids[others[fits[i]]]), int(score[fits[i]])


def code_rows(rows: DataFrame, scale: float = 256.0) -> DataFrame:
    """The index, from rows of ``id``, ``label`` and ``vector`` (doubles): components as whole numbers, codes, lengths and alignments."""

    def index(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            size = part["vector"].map(len)
            for dims, mine in part.groupby(size):
                x = np.floor(scale * np.array(mine["vector"].tolist(), dtype=np.float64).reshape(len(mine), dims))
                if not np.isfinite(x).all():
                    raise ValueError("components too large to be scaled")
                codes, norm, align = coded(x)
                yield pd.DataFrame({
                    "id": mine["id"], "label": mine["label"], "dims": int(dims), "vector": [v.tobytes() for v in x],
                    "code": [c.tobytes() for c in codes], "norm": norm, "align": align,
                })

    return rows.mapInPandas(index, INDEX)


def _meet(blocks: DataFrame, anchors: DataFrame, sizes: dict[str, int], find: Callable[[Block, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Every part of the anchors with every block of rows of their length."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    n_blocks, n_parts = sizes["blocks"], sizes["parts"]
    dealt = blocks.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int")).withColumn("part", every(n_parts))
    sent = anchors.withColumn("part", F.pmod(F.xxhash64("id", F.lit("a")), F.lit(n_parts)).cast("int")).withColumn("block", every(n_blocks))
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def search(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame(columns=names)
        return pd.DataFrame(list(find(Block(rows), asked)), columns=names)

    key = ["dims", "block", "part"]
    return dealt.groupBy(*key).cogroup(sent.groupBy(*key)).applyInPandas(search, schema)


def hard_negatives(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100,
    scale: float = 256.0, row_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    Components count as ``floor(scale * x)``; a score is the integer inner product with the anchor. Of each row that
    ``anchors`` selects the best ``positives`` rows of its label are its positives, and for each of them the best ``negatives``
    rows of other labels with ``least * positive_score <= 100 * score <= most * positive_score`` are returned,
    higher scores first, ties by smaller id; all, if there are fewer.

    Rows whose id, label or vector is null, or whose vector holds a null or non-finite component, take no part. Rows with equal id,
    label and vector are one; rows of one id never find each other. Vectors of different lengths are not compared. Other
    columns are not used, whatever their names. Scores beyond 2**56 raise an error.
    """
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    given = rows.select(
        F.col(row_id).cast("long").alias("i"), F.col(label).cast("long").alias("l"), F.col(vector).cast("array<double>").alias("v"), anchors.alias("a")
    ).filter(F.col("i").isNotNull() & F.col("l").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)))
    index = checkpointed(code_rows(given.select(F.col("i").alias("id"), F.col("l").alias("label"), F.col("v").alias("vector")), scale).distinct())
    asking = given.filter("a").select(F.col("i").alias("id")).distinct()
    asked = checkpointed(index.join(asking, "id", "left_semi").select("id", "label", "dims", "vector").withColumn("anchor", F.monotonically_increasing_id()))
    sizes = {"blocks": max(1, -(-index.count() // BLOCK)), "parts": max(1, -(-asked.count() // PART))}

    def alike(block: Block, mine: pd.DataFrame):
        anchor = mine["anchor"].to_numpy()
        return ((anchor[at], other, score) for at, other, score in nearest_alike(block, mine, positives))

    near = _meet(index, asked, sizes, alike, "anchor long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    best = near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= positives)
    best = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("n", "positive_id", "positive_score"))).alias("p"))
    ready = checkpointed(asked.join(best, "anchor").select(
        "*", F.col("p.positive_id").alias("positive_ids"), F.col("p.positive_score").alias("positive_scores")).drop("p"))

    def others(block: Block, mine: pd.DataFrame):
        anchor = mine["anchor"].to_numpy()
        return ((anchor[at], n, other, score) for at, n, other, score in nearest_others(block, mine, negatives, least, most))

    far = _meet(index, ready, sizes, others, "anchor long, n int, negative_id long, negative_score long")
    order = Window.partitionBy("anchor", "n").orderBy(F.desc("negative_score"), "negative_id")
    top = far.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    named = ready.select("anchor", F.col("id").alias("anchor_id"), "positive_ids", "positive_scores")
    return top.join(named, "anchor").select(
        "anchor_id", F.get("positive_ids", F.col("n")).alias("positive_id"), F.col("rank").cast("int").alias("rank"), "negative_id",
        F.get("positive_scores", F.col("n")).alias("positive_score"), "negative_score",
    )
