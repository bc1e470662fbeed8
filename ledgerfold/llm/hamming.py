"""Exact nearest binary codes by incremental multi-index hashing.

A code is cut into segments of 16 bits, four for each 64-bit word, and a table per segment lists the codes by its value. A
search probes all segment values within radius 0, 1, 2, ... of its own. Two codes of s segments that differ in at most
``s (r + 1) - 1`` bits agree in some segment up to r bits, so after radius r everything that near has been seen;
the search stops when its k-th verified distance is covered. Codes are dealt to blocks with tables of
their own, and a query's nearest are merged over the blocks.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.common import checkpointed
from ledgerfold.llm.neighbours import points, to_rows

BITS = 16
#: Codes of a block, queries that visit it together, and queries searched side by side.
BLOCK_CODES, BLOCK_QUERIES, SIDE_BY_SIDE = 32_768, 4_096, 32
POPULATION = np.bitwise_count(np.arange(1 << BITS, dtype=np.uint32)).astype(np.uint8)


def masks(radius: int) -> np.ndarray:
    """All segment values with so many bits set."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(BITS), radius)], dtype=np.int64)


def sign_code(vector: Column) -> Column:
    """One bit per component, set where it is positive (null ones give 0), in words of 64 bits: ``array<long>``. Null for a null
    vector."""
    none = F.lit(0).cast("long")
    bits = F.transform(vector, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i % 64)).otherwise(none))
    words = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(vector) / 64).cast("int"), F.lit(1)) - 1)
    word = lambda w: F.aggregate(F.slice(bits, w * 64 + 1, F.lit(64)), none, lambda a, x: a.bitwiseOR(x))
    return F.when(vector.isNotNull(), F.transform(words, word))


def segments_of(codes: pd.Series) -> np.ndarray:
    """Arrays of 64-bit words as rows of 16-bit segments."""
    return np.array(codes.tolist(), dtype="<i8").reshape(len(codes), -1).view("<u2")


def search_block(codes: np.ndarray, first: np.ndarray, count: np.ndarray, queries: np.ndarray, k: int):
    """``(query, code, distance)`` places and distances: of each query the ``k + 1`` codes that are nearest,
    ties to the least first id. Codes and queries are rows of 16-bit segments. A code counts as many rows as it has ids."""
    segments = codes.shape[1]
    of = [codes[:, s].astype(np.int64) for s in range(segments)]
    order = [np.argsort(v, kind="stable") for v in of]
    starts = [np.searchsorted(v[o], np.arange((1 << BITS) + 1)) for v, o in zip(of, order, strict=True)]
    probes: dict[int, np.ndarray] = {}
    for at in range(0, len(queries), SIDE_BY_SIDE):
        mine = queries[at : at + SIDE_BY_SIDE]
        q_of = [mine[:, s].astype(np.int64) for s in range(segments)]
        active, radius, seen = np.arange(len(mine)), 0, []
        rows_by_distance = np.zeros((len(mine), segments * BITS + 1), dtype=np.int64)
        while len(active):
            if radius not in probes:
                probes[radius] = masks(radius)
            for s in range(segments):
                values = q_of[s][active][:, None] ^ probes[radius][None, :]
                low, high = starts[s][values], starts[s][values + 1]
                size = (high - low).ravel()
                total = int(size.sum())
                if not total:
                    continue
                who = np.repeat(np.repeat(active, values.shape[1]), size)
                ends = np.cumsum(size)
                place = order[s][np.arange(total) + np.repeat(low.ravel() - (ends - size), size)]
                differ = codes[place] ^ mine[who]
                apart = [POPULATION[differ[:, i]] for i in range(segments)]
                # each code is taken once: in the first segment among those that differ least
                fresh = np.ones(total, dtype=bool)
                for i in range(segments):
                    if i != s:
                        fresh &= apart[i] > radius if i < s else apart[i] >= radius
                who, place = who[fresh], place[fresh]
                distance = sum(a[fresh].astype(np.int64) for a in apart)
                np.add.at(rows_by_distance, (who, distance), count[place])
                seen.append((who, place, distance))
            covered = rows_by_distance[active, : segments * (radius + 1)].sum(axis=1)
            active = active[covered < k + 1] if radius < BITS else active[:0]
            radius += 1
        if not seen:
            continue
        who, place, distance = (np.concatenate(x) for x in zip(*seen, strict=True))
        sort = np.lexsort((first[place], distance, who))
        who, place, distance = who[sort], place[sort], distance[sort]
        nth = np.arange(len(who)) - np.searchsorted(who, who)
        keep = nth < k + 1
        yield who[keep] + at, place[keep], distance[keep]


def nearest_codes(rows: DataFrame, queries: Column, k: int = 20, row_id: str = "vec_id", code: str = "code") -> DataFrame:
    """``query_id``, ``rank``, ``id`` and ``distance``: of each row that ``queries`` selects, the ``k`` other
    rows of least Hamming distance, ties to the smaller id; all others if there are fewer.

    Codes are arrays of 64-bit words; one with fewer words than others has zeros after them. Rows without a code take no part; rows with
    equal id and code are one. Rows of one id never find each
    other. Other columns are not used, whatever their names.
    """
    coded = rows.select(F.col(row_id).alias("id"), F.col(code).alias("code"), queries.alias("asks")).filter(
        "code IS NOT NULL AND id IS NOT NULL"
    )
    words = coded.agg(F.max(F.size("code"))).first()[0] or 1
    none = F.lit(0).cast("long")
    coded = coded.withColumn("code", F.concat("code", F.array_repeat(none, F.lit(words) - F.size("code"))))
    index = checkpointed(points(coded.select("id", "code"), "code", k))
    asked = coded.filter("asks").select(F.col("id").alias("query_id"), F.col("code").alias("q_code")).distinct()
    wanted = asked.select("q_code").distinct()
    blocks = max(1, -(-index.count() // BLOCK_CODES))
    parts = max(1, -(-wanted.count() // BLOCK_QUERIES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = index.select("code", "first_id", "n_ids", F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int").alias("block"), every(parts).alias("part"))
    sent = wanted.select("q_code", every(blocks).alias("block"), F.pmod(F.xxhash64("q_code", F.lit("q")), F.lit(parts)).cast("int").alias("part"))

    def search(codes: pd.DataFrame, mine: pd.DataFrame) -> pd.DataFrame:
        found = [
            pd.DataFrame({"q_code": mine["q_code"].to_numpy()[q], "code": codes["code"].to_numpy()[c], "first_id": codes["first_id"].to_numpy()[c], "distance": d})
            for q, c, d in search_block(
                segments_of(codes["code"]), codes["first_id"].to_numpy(np.int64), codes["n_ids"].to_numpy(np.int64), segments_of(mine["q_code"]), k,
            )
        ] if len(codes) and len(mine) else []
        names = ["q_code", "code", "first_id", "distance"]
        return pd.concat(found) if found else pd.DataFrame({c: pd.Series(dtype="object" if "code" in c else "int64") for c in names})

    near = dealt.groupBy("block", "part").cogroup(sent.groupBy("block", "part")).applyInPandas(
        search, "q_code array<long>, code array<long>, first_id long, distance long"
    )
    ranked = Window.partitionBy("q_code").orderBy("distance", "first_id")
    best = near.withColumn("n", F.row_number().over(ranked)).filter(F.col("n") <= k + 1).select("q_code", "code", "distance")
    return to_rows(best, index, asked, ["code"], "distance", F.col("distance"), k)
