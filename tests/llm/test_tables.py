"""Operators on whole tables: n-gram join, searches, shards, mix, and the pipeline."""

from __future__ import annotations

import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerfold.llm import ann, hamming, mixing, ngram_join, sharding
from ledgerfold.llm.components import components

# -- components --------------------------------------------------------------------------------------------


def test_components_of_a_chain_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(5000, 5000), (None, 3), (7000, 6000)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1100)} | {6000: 6000, 7000: 6000}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- n-gram join -------------------------------------------------------------------------------------------


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3)))


def brute_components(rows):
    sets = {d: shingle_set(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 85 * len(x | y):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {d: (len(sets[d]), root(d)) for d in sets}


def corpus(n=160, seed=2):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = " ".join(r.choice(vocabulary) for _ in range(30))
    texts = []
    for _ in range(n // 8):
        words = [r.choice(vocabulary) for _ in range(r.choice([3, 5, 30, 120]))]
        for _ in range(8):
            copy = words[:]
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            texts.append((passage + " " if r.random() < 0.2 else "") + " ".join(copy))
    return texts + [None, "", " \n", "One", "one", "one two", "ONE\ttwo", "É x y z", "é x y z"]


@pytest.mark.parametrize("seed", [2, 3])
def test_join_against_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(ngram_join, "BLOCK", 5)  # groups and clusters of many blocks
    rows = list(enumerate(corpus(seed=seed)))
    df = spark.createDataFrame([(d, t, 0, "x") for d, t in rows], "doc_id long, text string, n long, sid string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link_documents(df).collect()}
    assert got == brute_components(rows)


def test_tree_join_against_all_pairs():
    r = np.random.default_rng(4)
    whole = np.unique(r.integers(0, 1 << 60, 90).astype(np.uint64))
    sets = [np.unique(np.concatenate([r.choice(whole, r.integers(1, 90), replace=False), r.integers(0, 99, r.integers(0, 4)).astype(np.uint64)])) for _ in range(60)]
    sets += [whole, whole, whole[:1], whole[:80]]
    want = {
        (i, j) for i, a in enumerate(sets) for j, b in enumerate(sets)
        if 100 * len(np.intersect1d(a, b)) >= 60 * len(np.union1d(a, b))
    }
    got = {(int(i), int(j)) for x, y in ngram_join.tree_join(sets, sets, 60) for i, j in zip(x, y, strict=True)}
    assert got == want


def test_bitmaps_rule_out_no_link():
    r = np.random.default_rng(6)
    sets = []
    for n in (3, 40, 500, 900, 1100, 2000):
        base = np.unique(r.integers(0, 1 << 62, n).astype(np.uint64))
        for k in range(6):
            sets.append(np.unique(np.concatenate([base[k * n // 40 :], r.integers(0, 1 << 62, k * n // 60).astype(np.uint64)])))
    sizes = np.array([len(s) for s in sets])
    may = {tuple(sorted(p)) for a, b in ngram_join.may_link([ngram_join.bitmap(s) for s in sets], sizes, 85) for p in zip(a.tolist(), b.tolist(), strict=True)}
    for i, j in combinations(range(len(sets)), 2):
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j])):
            assert (i, j) in may


def test_join_of_empty_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert ngram_join.link_documents(spark.createDataFrame([], schema)).count() == 0
    text = "a b c d e f g"
    got = ngram_join.link_documents(spark.createDataFrame([(4, text), (4, text), (2, text), (9, "word " * 30_000)], schema))
    got = got.select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect())) == [(2, 4, 2), (4, 4, 2), (4, 4, 2), (9, 1, 9)]
    near = "a b c d e f g " * 9 + "h i j k"
    rows = [(1, near), (1, "other words on one id"), (3, near + " l"), (None, near), (None, None)]
    got = ngram_join.link_documents(spark.createDataFrame(rows, schema)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(1, 1), (3, 1), (None, None)} and len(got) == 5


def test_counts_are_added_up_in_two_steps(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PARTITIONS", 3)
    texts = ["a b c d", "a b c d e", "x y z w"] * 10
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(10)
    described = ngram_join.describe(docs, 4).localCheckpoint()
    rows = ngram_join.partial_counts(described).groupBy("slice").count().agg(F.max("count")).first()[0]
    want = np.zeros(1 << ngram_join.BUCKET_BITS, dtype=np.int64)
    for t in texts:
        np.add.at(want, (ngram_join.shingles(t) >> np.uint64(64 - ngram_join.BUCKET_BITS)).astype(np.int64), 1)
    assert rows <= 4 and (ngram_join.bucket_counts(described) == want).all()


# -- searches ----------------------------------------------------------------------------------------------


def search_rows(n=300, seed=1):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 16)).astype(np.float32)
    x[50:150] = x[7]  # a third are copies
    x[150:170] = x[9] + r.normal(size=(20, 16)) * 0.01
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


def test_hamming_search_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hamming, "BLOCK_CODES", 40)
    monkeypatch.setattr(hamming, "BLOCK_QUERIES", 5)
    rows = search_rows() + [(998, None), (7, search_rows()[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("code", hamming.sign_code(F.col("embedding")))
    got = {}
    for r in hamming.nearest_codes(df.withColumn("id", F.lit("x")), F.col("vec_id") % 20 == 0, k=7).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["distance"]))
    codes = {i: sum(1 << j for j, v in enumerate(x) if v > 0) for i, x in rows if x}
    for q in [i for i in codes if i % 20 == 0]:
        near = sorted((bin(codes[q] ^ c).count("1"), i) for i, c in codes.items() if i != q)[:7]
        assert sorted(got[q]) == [(n + 1, i, d) for n, (d, i) in enumerate(near)]


def test_hamming_search_with_few_rows(spark):
    df = spark.createDataFrame([(0, 5), (3, 5), (1, -1), (2, None)], "vec_id long, code long")
    got = hamming.nearest_codes(df, F.col("vec_id") % 20 == 0).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 3, 0), (0, 2, 1, 62)]
    assert hamming.nearest_codes(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_vector_search_recall_ties_and_unusable_rows(spark):
    rows = search_rows(900) + [
        (1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [1.0, None] + [0.0] * 14),
        (1004, [float("inf")] + [0.0] * 15), (1020, [1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = {}
    for r in ann.nearest_vectors(df, F.col("vec_id") % 20 == 0, parts=8).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["id"], r["score"])
    x = np.array([v for _, v in rows[:900]])
    hits = 0
    for q in range(0, 900, 20):
        s = (x * x[q]).sum(axis=1)
        s[q] = -np.inf
        best = np.lexsort((np.arange(900), -s))[:20]
        hits += len({i for i, _ in got[q].values()} & set(best.tolist()))
        assert sorted(got[q]) == list(range(1, 21))
        assert all(score == pytest.approx(s[i], abs=1e-12) for i, score in got[q].values())
        ranked = [got[q][n] for n in range(1, 21)]
        assert ranked == sorted(ranked, key=lambda p: (-p[1], p[0]))
    assert hits / (45 * 20) >= 0.9 and set(got) == set(range(0, 900, 20))


def test_vector_search_goes_on_to_other_parts_until_there_are_enough_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "AIM", 0.5)
    r = np.random.default_rng(3)
    x = np.repeat(r.normal(size=(10, 16)), 20, axis=0) + r.normal(size=(200, 16)) * 0.02
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = ann.nearest_vectors(df, F.col("vec_id") % 20 == 0, parts=10).groupBy("query_id").count().collect()
    assert {c["query_id"]: c["count"] for c in found} == {q: 20 for q in range(0, 200, 20)}


def test_vector_search_beyond_the_sample_visits_few_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE", 1024)  # the table is six times as large
    r = np.random.default_rng(8)
    x = np.repeat(r.normal(size=(60, 24)), 105, axis=0) + r.normal(size=(6300, 24)) * 0.3
    x = x[r.permutation(len(x))]
    kept, plain = {}, ann.measured
    monkeypatch.setattr(ann, "measured", lambda *a: kept.setdefault("router", plain(*a)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for row in ann.nearest_vectors(df, F.col("vec_id") % 20 == 0, parts=40).collect():
        got.setdefault(row["query_id"], set()).add(row["id"])
    asked = np.arange(0, len(x), 20)
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -np.inf
    best = np.argpartition(-score, 19, axis=1)[:, :20]
    assert np.mean([len(got[q] & set(b.tolist())) / 20 for q, b in zip(asked.tolist(), best, strict=True)]) >= 0.9
    held = np.bincount(kept["router"].chances(x).argmax(axis=1), minlength=40)
    visited = [held[parts].sum() / len(x) for parts in kept["router"].routes(x[asked], held, 21)]
    assert np.mean(visited) <= 0.2


def test_vector_search_with_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (5, [-1.0, 3.0])], "vec_id long, embedding array<float>")
    got = ann.nearest_vectors(df, F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 5, -1.0)]
    assert ann.nearest_vectors(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_parts_are_balanced_and_keep_neighbours():
    r = np.random.default_rng(0)
    x = ann.unit(np.repeat(r.normal(size=(8, 16)), 60, axis=0) + r.normal(size=(480, 16)) * 0.05)
    graph = ann.neighbour_graph(x, 10)
    label = ann.cut_graph(x, graph, 8, r)
    assert np.bincount(label, minlength=8).max() <= np.ceil(1.1 * 60)
    assert (label[graph] == label[:, None]).mean() > 0.8


def test_codes_cover_every_component(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(300, 150))
    x[:40, :130] = x[0, :130]  # alike but for the last components
    rows = [(i, v.tolist()[: 150 if i % 9 else 100], "x") for i, v in enumerate(x)] + [(1000, None, "x"), (1001, [], "x"), (1002, [None, 1.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, CODE string")
    coded = df.select("vec_id", hamming.sign_code(F.col("embedding")).alias("code"))
    bits = {i: np.array([(c is not None and c > 0) for c in v] + [False] * (150 - len(v))) for i, v, _ in rows if v is not None}
    found = {}
    for row in hamming.nearest_codes(coded, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(row["query_id"], []).append((row["rank"], row["distance"], row["id"]))
    for q in (i for i in bits if i % 20 == 0):
        want = sorted((int((bits[q] != b).sum()), i) for i, b in bits.items() if i != q)[:20]
        assert [(d, i) for _, d, i in sorted(found[q])] == want


# -- shards ------------------------------------------------------------------------------------------------


def sharded(spark, rows, tree):
    df = spark.createDataFrame(rows, "doc_id long, text string, Size string, SHARD string")
    return sharding.numbered(sharding.assign(sharding.measure(df).drop("text"), tree), ties=("text_crc32", "size"))


def test_shards_sizes_and_slots(spark):
    rows = [(i, f"text é {i % 50}", "old", "old") for i in range(2000)] + [(None, None, "", ""), (5, "", "", ""), (5, "", "", "")]
    tree = sharding.ShardTree.even(2, 2, 3)
    out = sharded(spark, rows, tree).collect()
    assert len(out) == len(rows) and {r["shard"] for r in out} == set(range(12))
    for s in range(12):
        mine = [r["slot"] for r in out if r["shard"] == s]
        assert sorted(mine) == list(range(len(mine))) and 100 <= len(mine) <= 240
    byte = {i: t.encode() for i, t, _, _ in rows[:2000]}
    for r in out:
        if r["doc_id"] is not None and r["doc_id"] > 5:
            assert r["size"] == len(byte[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(byte[r["doc_id"]])
    (none,) = [r for r in out if r["doc_id"] is None]
    assert none["size"] == 16 and none["text_crc32"] == 0
    assert sharded(spark, [], tree).count() == 0


def test_growth_moves_rows_into_the_new_shard_alone(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    tree, moved = sharding.ShardTree.even(2, 4, 5), 0
    for _ in range(3):
        both = sharding.assign(sharding.assign(df, tree, shard="old"), tree.grown(), shard="new").collect()
        assert all(r["new"] in (r["old"], tree.shards) for r in both)
        moved += sum(r["new"] != r["old"] for r in both)
        tree = tree.grown()
    assert 3 * 20_000 / 43 * 0.8 < moved < 3 * 20_000 / 41 * 1.2


def test_weights_and_where_movement_stays(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    old = sharding.ShardTree((((1.0, 1.0), (2.0, 1.0)), ((1.0, 1.0), (3.0, 0.0))))
    new = sharding.ShardTree((((1.0, 1.0), (2.0, 1.0)), ((1.0, 1.0), (1.0, 0.0))))
    both = sharding.assign(sharding.assign(df, old, shard="old"), new, shard="new").collect()
    share = np.bincount([r["old"] for r in both], minlength=8) / 20_000
    assert np.allclose(share, np.array([1, 1, 2, 1, 1, 1, 3, 0]) / 10, atol=0.012)
    # only the rack that lost weight gives rows away, and rows of the other region stay where they are
    assert all(r["old"] in (6,) or r["new"] == r["old"] or r["old"] in (4, 5) for r in both)
    assert all(r["new"] == r["old"] for r in both if r["old"] < 4)


# -- mix ---------------------------------------------------------------------------------------------------


def water_fill(sizes, weights=(1, 2, 3), most=3):
    names = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    stopped, total = {}, sum(sizes.values())
    while True:
        left = total - sum(stopped.values())
        open_w = sum(w[s] for s in names if s not in stopped)
        new = {s: most * sizes[s] for s in names if s not in stopped and w[s] * left > most * sizes[s] * open_w}
        if not new:
            return {s: stopped[s] if s in stopped else w[s] * left / open_w for s in names}
        stopped |= new


def test_mix_targets_and_taken_words(spark):
    r = random.Random(9)
    sources = ["a", "b", "c", "d", None, "tiny"]
    rows = [(i, r.choice(sources[:5]), "w " * r.randint(0, 300), 1) for i in range(300)]
    rows += [(900, "tiny", "one two", 1), (900, "tiny", "one two", 1), (901, "a", None, 1), (901, "a", None, 1), (902, "zero", "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, size int")
    mix, placed = mixing.schedule(df, block=64)
    out = mixing.taken(mix, placed).collect()
    assert len(out) == len(rows)
    sizes = {}
    for _, s, t, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = water_fill(sizes)
    for s in sizes:
        mine = [x for x in out if x["source"] == s]
        assert all(x["source_size"] == sizes[s] and x["target"] == pytest.approx(want[s]) for x in mine)
        assert abs(sum(x["taken"] for x in mine) - want[s]) <= 1
        assert all(x["taken"] <= 3 * x["size"] for x in mine)
    # the schedule: every slot is one block, and at any point sources are near their shares
    pieces = mix.collect()
    assert all(p["words"] <= 64 and p["words"] > 0 for p in pieces)
    slots = sorted({(p["slot"], p["place"]) for p in pieces if p["slot"] is not None})
    assert len({s for s, _ in slots}) == len(slots)
    again = {(x["doc_id"], x["size"], x["taken"]) for x in mixing.taken(*mixing.schedule(df.repartition(5), block=64)).collect()}
    assert again == {(x["doc_id"], x["size"], x["taken"]) for x in out}


def test_mix_stays_near_its_shares_all_along(spark):
    plan = spark.createDataFrame([(0, 1000), (1, 2000), (2, 3000)], "place int, budget long")
    dealt = sorted((x["slot"], x["place"]) for x in mixing.slots(spark, plan, 10).collect())
    assert [s for s, _ in dealt] == list(range(600))
    counts = np.zeros(3)
    for n, (_, p) in enumerate(dealt, 1):
        counts[p] += 1
        assert np.abs(counts - n * np.array([1, 2, 3]) / 6).max() <= 3


def test_mix_of_nothing(spark):
    schema = "doc_id long, source string, text string"
    assert mixing.taken(*mixing.schedule(spark.createDataFrame([], schema))).count() == 0
    (row,) = mixing.taken(*mixing.schedule(spark.createDataFrame([(1, "a", None)], schema))).collect()
    assert row["taken"] == 0 and row["target"] == 0.0


# -- pipeline ----------------------------------------------------------------------------------------------


def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline as pipeline

    r = random.Random(4)
    vocabulary = {"en": "the and of ing ther tion was".split(), "fr": "le éau eux la été oui où".split()}
    rows = []
    for i in range(120):
        lang = r.choice(["en", "fr"])
        rows.append((i, " ".join(r.choice(vocabulary[lang]) for _ in range(r.randint(20, 60))), lang, f"s{i % 3}", 0))
    rows += [(200 + i, rows[0][1], "en", "s1", 0) for i in range(5)]
    rows += [(300, None, "en", "s1", 0), (301, "123 ...", "en", "s1", 0), (302, rows[5][1] + " a@b.cd", None, None, 0), (302, "the and of", None, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    known = pipeline.known_language(spark, df, "")
    assert known.columns == df.columns
    assert {x["doc_id"] for x in known.collect()} == {x[0] for x in rows} - {300, 301}
    single = pipeline.one_of_each_group(spark, known, "").collect()
    assert not [x for x in single if 200 <= x["doc_id"] < 300] and len(single) == 121
    assert [x["text"] for x in single if x["doc_id"] == 302] == ["the and of"]  # the other text on this id is 5's
    clean = pipeline.masked(spark, spark.createDataFrame(single, df.schema), "")
    assert not clean.filter(F.col("text").contains("@")).count() and clean.count() == len(single)
    mixed = pipeline.mixed(spark, clean, "")
    words = lambda d: d.select(F.sum(F.size(F.split("text", " ")))).first()[0]
    assert mixed.columns == df.columns and abs(words(mixed) - words(clean)) < 60 * 4
    out = pipeline.encoded(spark, mixed, "").collect()
    assert len(out) == mixed.count() and all(len(x["ids"]) == x["n_tokens"] for x in out)


def test_pipeline_drops_copies_of_a_similarity_from_80_percent(spark):
    import corpus_pipeline as pipeline

    text = lambda start, n: " ".join(f"w{start + i}" for i in range(n))
    rows = [
        (1, text(0, 500)), (2, text(0, 600)),  # 496 of 596 runs of five words, 497 of 597 of four
        (3, text(1000, 500)), (4, text(1000, 630)),  # 496 of 626
        (5, text(2000, 30)), (5, text(3000, 30)),  # two texts on one id
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = pipeline.one_of_each_group(spark, docs, "").collect()
    assert sorted((x["doc_id"], x["text"]) for x in got) == sorted(r for r in rows if r[0] != 2)


def test_pipeline_of_nothing(spark):
    import corpus_pipeline as pipeline

    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0
