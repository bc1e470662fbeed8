"""Hash trees of a table against a plain walk of the same trees."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from ledgerfold.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def flanks(tree, place):
    for level in tree[:-1]:
        run = place // 16 * 16
        yield level[run:place], level[place + 1 : run + 16]
        place //= 16


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    trees = {g: levels([r[2] for r in groups[g]]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for i, g in enumerate(names):
        for p, (_, key, leaf, now) in enumerate(groups[g]):
            path = [*flanks(trees[g], p), *flanks(top, i)]
            for left, right in path:
                now = h(*left, now, *right)
            proof = h(*[s for left, right in path for s in left + right])
            out.append((g, key, leaf, trees[g][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple(map(str, r)))


def test_trees_of_all_shapes(spark):
    r = random.Random(3)
    shapes = [(None, 3), ("a", 1), ("b", 16), ("c", 17), ("é", 256), ("d", 257), ("z", 4096), ("y", 4097), ("big", 9000)]
    rows = []
    for g, n in shapes + [(f"s{i}", 2) for i in range(30)]:
        for i in range(n):
            digest = h(g or "", str(i))
            # keys are null, repeated and out of order here and there
            rows.append((g, i * 7 % n // 2 if i % 50 else None, digest, digest if r.random() < 0.8 else h("x", digest), "other"))
    df = spark.createDataFrame(rows, "source string, doc_id long, leaf string, now string, POS string")
    assert ordered(merkle.proofs(merkle.build(df, now="now")).collect()) == ordered(brute([x[:4] for x in rows]))


def test_lone_leaves_repeated_rows_and_no_rows(spark):
    schema = "source string, doc_id long, leaf string"
    digest = h("x")
    one = merkle.proofs(merkle.build(spark.createDataFrame([("s", 1, digest)], schema))).collect()
    assert [tuple(r) for r in one] == [("s", 1, digest, digest, digest, h(), digest, True)]
    same = [("s", 1, digest)] * 20
    got = merkle.proofs(merkle.build(spark.createDataFrame(same, schema))).collect()
    assert ordered(got) == ordered(brute([(*r, r[2]) for r in same]))
    assert merkle.proofs(merkle.build(spark.createDataFrame([], schema))).count() == 0


def test_leaves_name_nulls_and_lengths_in_bytes(spark):
    df = spark.createDataFrame([(7, None, "é;", ""), (None, "-", None, "w " * 400_000)], "a long, b string, c string, d string")
    got = [r[0] for r in df.select(merkle.leaf_digest(*[F.col(c) for c in "abcd"])).collect()]
    assert got == [h("1:7", "-", "3:é;", "0:"), h("-", "1:-", "-", "800000:", "w " * 400_000)]
