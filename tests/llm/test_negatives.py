"""Hard negatives against all pairs, and intervals against true products."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerfold.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, ID string, block int"


def brute(rows, every=3, k=5, least=80, most=100):
    fine = {(i, lab, tuple(v)) for i, v, lab in rows if None not in (i, v, lab) and all(x is not None and math.isfinite(x) for x in v)}
    whole = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in fine]
    out = []
    for i, lab, v in whole:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in whole if j != i and len(w) == len(v)]
        for p, j, other in sorted(s for s in scored if s[2] == lab)[:k]:
            fits = sorted((n, m) for n, m, o in scored if o != lab and least * -p <= 100 * -n <= most * -p)
            out += [(i, j, r + 1, m, -p, -n) for r, (n, m) in enumerate(fits[:k])]
    return sorted(out)


def found(spark, rows, every=3, **more):
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)
    return sorted(map(tuple, negatives.hard_negatives(df, F.col("vec_id") % every == 0, **more).collect()))


def vectors(n=150, dims=20, seed=5):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(4, dims))
    x = centres[r.integers(0, 4, n)] + r.normal(size=(n, dims)) * 0.6
    x[::13] = x[0]  # copies under many ids and labels
    return [(i, v.tolist(), int(r.integers(0, 3))) for i, v in enumerate(x)]


def test_negatives_against_all_pairs(spark, monkeypatch):
    rows = vectors()
    monkeypatch.setattr(negatives, "BLOCK", 40)
    monkeypatch.setattr(negatives, "PART", 7)
    want = brute(rows)
    assert len(want) > 500 and found(spark, rows) == want


def test_other_windows_and_counts(spark):
    rows = vectors(90, 70, 6)
    assert found(spark, rows, least=50, most=120, positives=3, negatives=3) == [
        r for r in brute(rows, k=3, least=50, most=120)
    ]


def test_nulls_repeats_lengths_and_odd_numbers(spark):
    v = [0.5, -0.25]
    rows = [
        (None, v, 1), (1, None, 1), (2, v, None), (4, [0.5, None], 1), (5, [math.nan, 1.0], 1), (7, [math.inf, 1.0], 2),
        (0, v, 1), (0, v, 1), (0, [0.5, 0.5], 2), (3, [0.0, 0.0], 1), (6, [], 1), (8, [], 2), (9, [], 1), (10, v, 1), (11, [0.45, -0.2], 2),
        (12, [1.0, 2.0, 3.0], 1), (13, [1.0, 2.0, 3.0], 1), (14, [1.0, 2.0, 2.9], 3), (15, [-0.5, 0.25], 1), (18, [3e5, 2.0], 1),
        (19, [3e5, 1.0], 1), (20, [2.9e5, 1.0], 2),
    ]
    want = brute(rows)
    assert {r[0] for r in want} >= {0, 6, 9, 12, 18} and found(spark, rows) == want
    assert found(spark, []) == [] and found(spark, [(1, v, 1)]) == []


@pytest.mark.parametrize("dims", [1, 3, 64, 100, 130])
def test_intervals_hold_the_true_product(dims):
    r = np.random.default_rng(dims)
    x = np.floor(256 * r.normal(size=(500, dims)) * r.choice([0, 1e-3, 1, 50], size=(500, 1)))
    codes, norm, align = negatives.coded(x)
    for q in x[:40]:
        low, high = negatives.intervals(codes, norm, align, q)
        score = negatives.products(x, q)
        assert (low <= score).all() and (score <= high).all()
    alike = np.floor(256 * (r.normal(size=dims) + 0.05 * r.normal(size=(500, dims))))
    if dims >= 64:  # the interval tells near rows from far ones
        low, _ = negatives.intervals(*negatives.coded(alike), alike[0])
        _, high = negatives.intervals(*negatives.coded(-alike), alike[0])
        assert (low > high.max()).mean() > 0.9


def test_scores_that_do_not_fit_raise():
    with pytest.raises(ValueError):
        negatives.products(np.full((1, 2), 2.0**40), np.full(2, 2.0**40))
