"""The trigram model against a plain one of dictionaries, and its compact sequences against lists."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerfold.llm import ngram_lm as lm

SCHEMA = "doc_id long, text string, Score string, chunk int"


def tokens(text):
    return (text or "").encode().lower().split() + [None]


class Plain:
    """Counts in dictionaries."""

    def __init__(self, texts):
        self.one, self.two, self.three, self.first, self.pair = (Counter() for _ in range(5))
        for t in texts:
            s = ["<", "<", *tokens(t)]
            for u, v, w in zip(s, s[1:], s[2:]):
                self.one[w] += 1
                self.two[v, w] += 1
                self.first[v] += 1
                self.three[u, v, w] += 1
                self.pair[u, v] += 1
        self.n, self.v = sum(self.one.values()), len(self.one)

    def chance(self, u, v, w):
        p = (self.one[w] + 1) / (self.n + self.v + 1)
        p = (self.two[v, w] + lm.M2 * p) / (self.first[v] + lm.M2)
        return (self.three[u, v, w] + lm.M3 * p) / (self.pair[u, v] + lm.M3)

    def scores(self, text):
        s = ["<", "<", *tokens(text)]
        base = sum(math.log10((self.one[w] + 1) / (self.n + self.v + 1)) for w in s[2:])
        score = sum(math.log10(self.chance(*x)) for x in zip(s, s[1:], s[2:]))
        return len(s) - 2, sum(self.one[w] > 0 for w in s[2:]), self.n, base, score


@pytest.mark.parametrize("values", [[], [0], [5], [0, 0, 0], [0, 1, 2, 3], [7, 7, 9, 10**14, 10**14 + 1], list(range(0, 9000, 3))])
def test_rising_sequences(values):
    got = lm.Rising.of(np.array(values, dtype=np.int64))
    again = lm.Rising.read(lm.unpack(lm.pack(*got.parts())))
    assert again[np.arange(len(values))].tolist() == values


def test_rising_sequences_at_random():
    r = np.random.default_rng(1)
    for top in (1, 50, 10**6, 10**13):
        values = np.sort(r.integers(0, top, 5000))
        at = r.integers(0, 5000, 999)
        rising = lm.Rising.of(values)
        assert (rising[at] == values[at]).all() and (rising.values() == values).all()
        asked = np.concatenate([values[at], r.integers(0, top + 5, 500), [0, top * 9]])
        low = np.minimum(np.searchsorted(values, asked), r.integers(0, 5000, len(asked)))
        high = np.full(len(asked), 4000)
        place = rising.find(asked, low, high)
        found = place >= 0
        assert (values[place[found]] == asked[found]).all() and (place[found] < 4000).all() and (place[found] >= low[found]).all()
        assert not any(v in set(values[a:4000].tolist()) for v, a in zip(asked[~found].tolist(), low[~found].tolist()))


def corpus(n=120, seed=3):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(25)] + ["É", "\x00", "\x01"]
    texts = [" ".join(r.choice(words[: r.choice([3, 28])]) for _ in range(r.choice([0, 1, 2, 9, 40]))) for _ in range(n)]
    return texts + [None, "", " \n\t", "W1 w1\x0bW1", "w1 " * 400, "unseen words only", "same text", "same text"]


def check(spark, texts, train):
    rows = [(i if i % 11 else None, t, "x", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    learn = F.when(F.col("doc_id").isNull(), None).otherwise(F.col("doc_id") % 7 != 2)
    got = lm.text_scores(df, learn).collect()
    model = Plain([t for i, t, *_ in rows if i is None or i % 7 != 2]) if train else None
    want = sorted(((-1 if i is None else i, i is not None and i % 7 == 2, *model.scores(t)) for i, t, *_ in rows), key=str)
    have = sorted(((-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, got)), key=str)
    assert len(have) == len(want)
    key = lambda x: (x[0], x[2], x[3], round(x[5], 4), round(x[6], 4))
    for a, b in zip(sorted(have, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-9)
        yield a[6], b[6]


def test_scores_against_dictionaries(spark):
    for a, b in check(spark, corpus(), True):  # no level has more values than codes
        assert a == pytest.approx(b, abs=1e-9)


def test_scores_of_many_chunks_shards_and_shared_words(spark, monkeypatch):
    chunks = lm.chunked(spark.createDataFrame([(i, t) for i, t in enumerate(corpus())], "doc_id long, text string").repartition(5), F.lit(True))
    sizes = lm.measured(chunks)
    small = lm.Sizes(sizes.tokens, sizes.words, sizes.texts, 7, {w: n for w, n in counts_of(chunks).items() if n > 90}, sizes.common[::2])
    assert len(small.hot) > 3
    monkeypatch.setattr(lm, "TOGETHER", 40)
    monkeypatch.setattr(lm, "measured", lambda _: small)
    for (a, b), (c, _) in zip(check_all(spark, corpus()), check_all(spark, corpus(), plain=True), strict=True):
        assert a == pytest.approx(c, abs=1e-9) and b == pytest.approx(c, rel=0.02, abs=0.02)


def counts_of(chunks):
    out = Counter()
    for r in chunks.collect():
        c = lm.Chunk.read(bytes(r["body"]))
        for w, n in zip(c.words.tolist(), c.word_counts().tolist(), strict=True):
            out[w] += n
    return out


def check_all(spark, texts, plain=False):
    if plain:
        model = Plain(texts)
        return [(s, s) for *_, s in (model.scores(t) for t in texts)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = sorted(lm.text_scores(df, F.lit(True)).collect())
    model = Plain(texts)
    for r, t in zip(got, texts, strict=True):
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == model.scores(t)[:3]
    return [(model.scores(t)[4], r["score"]) for r, t in zip(got, texts, strict=True)]


def test_chances_add_up_to_one():
    model = Plain(corpus())
    words = [*model.one, "never met"]
    for context in [("<", "<"), ("<", b"w1"), (b"w1", b"w2"), (b"no", b"such"), (b"w1", b"no")]:
        assert sum(model.chance(*context, w) for w in words) == pytest.approx(1)


def test_tries_hold_what_was_counted(spark):
    texts = corpus(60, 5)
    tries, sizes = lm.model(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    plain = Plain(texts)
    assert (sizes.tokens, sizes.words, sizes.texts) == (plain.n, plain.v, len(texts))
    held = [lm.Trie(bytes(r["trie"])) for r in tries.collect()]
    assert sum(t.pairs.n for t in held) == len(plain.two) + 1 and sum(t.triples.n for t in held) == len(plain.three)


def test_nothing_to_learn_from_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = sorted(map(tuple, lm.text_scores(df, F.lit(False)).collect()))
    assert got == [(1, True, 3, 0, 0, 0.0, 0.0), (2, True, 1, 0, 0, 0.0, 0.0)]
    assert lm.text_scores(df.limit(0), F.lit(True)).count() == 0


def test_long_texts_are_split_at_white_space(monkeypatch):
    monkeypatch.setattr(lm, "STRETCH", 7)
    for text in ("", "a", "word " * 50, "w" * 40 + " x", " \t\x0b" * 9 + "É é", "ab cd\n" * 7):
        assert [w for part in lm._stretches(text) for w in part] == text.encode().lower().split()
