import difflib
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from helpers import event, ledger
from ledgerfold.operators import changes, curation, graph, reconcile, skew
from ledgerfold.operators.resolve import resolve
from ledgerfold.spec import LedgerSpec

WORDS = "wind lidar wake turbine farm model data report offshore blade load noise ice".split()


def titles(rng, n):
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            t = list(rng.choice(out))
            for _ in range(rng.randrange(1, 5)):
                i = rng.randrange(len(t) + 1)
                t[i:i + rng.randrange(2)] = rng.choice(["", "x", "e", "s "])
            out.append("".join(t).strip() or "x")
        else:
            out.append(" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 9))))
    return out


def test_title_index_misses_no_similar_pair(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("ab"), t) for i, t in enumerate(titles(rng, 400) + ["abc", "abd", "ab", "a", "abcdef", "abcdefg"])]
    df = spark.createDataFrame(rows, "identity_key int, block string, title string")
    heads = {}
    for i, b, t in rows:
        if t:
            heads[b, t] = min(i, heads.get((b, t), i))
    want = {(heads[b, t], i) for i, b, t in rows if t and heads[b, t] != i}
    near = lambda t, u: difflib.SequenceMatcher(None, t, u).ratio() >= 0.9
    for ((b, t), i), ((c, u), j) in combinations(heads.items(), 2):
        if b == c and (near(t, u) or near(u, t)):
            want.add((min(i, j), max(i, j)))
    got = {(r["left"], r["right"]) for r in reconcile.fuzzy_pairs(df, ["block"]).collect()}
    assert got == want and len(want) > 100
    # Hot keys take the broadcast branch and must not change the answer.
    same = reconcile.similar_titles(df.select("block", "title").distinct(), ["block"])
    hot = reconcile.similar_titles(df.select("block", "title").distinct(), ["block"], hot_rows=3)
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, hot.collect()))


@pytest.mark.parametrize("copies", [2, 20, 21, 5000])
def test_one_rule_for_any_number_of_copies(spark, copies):
    rows = [(i, "b", "wind lidar") for i in range(copies)] + [(9_000, "b", "wind lidars"), (9_001, "b", "wind lidars")]
    df = spark.createDataFrame(rows, "identity_key int, block string, title string")
    got = {(r["left"], r["right"]) for r in reconcile.fuzzy_pairs(df, ["block"]).collect()}
    assert got == {(0, i) for i in range(1, copies)} | {(0, 9_000), (9_000, 9_001)}
    ranked = reconcile.fuzzy_pairs(df.withColumn("rank", -F.col("identity_key")), ["block"])
    assert {(r["left"], r["right"]) for r in ranked.collect()} == (
        {(i, copies - 1) for i in range(copies - 1)} | {(9_000, 9_001), (copies - 1, 9_001)})
    members = reconcile.title_members(df, ["block"]).filter("title = 'wind lidar'")
    assert members.count() == copies and {r["head"] for r in members.collect()} == {0}


def test_a_near_title_keeps_a_link_when_heads_are_decided(spark):
    df = spark.createDataFrame([(i, "b", "wind lidar") for i in range(3)] + [(9, "b", "wind lidars")], "identity_key int, block string, title string")
    links = reconcile.possible_links(df, ["block"], 0.9)
    across = {(r["left"], r["right"]) for r in links.filter("left_title <> right_title").collect()}
    assert across == {(0, 9), (1, 9), (2, 9)}  # the best one that isn't decided is proposed


def test_components_of_chains_stars_and_cycles(spark):
    pairs = [(i, i + 1) for i in range(100)] + [(500, i) for i in range(501, 560)] + [(900, 901), (901, 902), (902, 900), (7, 7)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in reconcile.connected_components(df, "a", "b").collect()}
    assert all(got[i] == 0 for i in range(101)) and all(got[i] == 500 for i in range(500, 560))
    assert {got[900], got[901], got[902]} == {900}


def test_hot_keys_join_to_the_same_rows(spark):
    detail = spark.createDataFrame([("hot", i) for i in range(40)] + [("cold", 1), ("alone", 2)], "k string, v int")
    per = detail.groupBy("k").agg(F.max("v").alias("m"), F.count(F.lit(1)).alias("rows")).filter("k <> 'alone'")
    a = sorted(map(tuple, skew.per_key_join(detail, per, ["k"], hot_rows=10).collect()))
    b = sorted(map(tuple, skew.per_key_join(detail, per, ["k"]).collect()))
    assert a == b and len(a) == 41
    left = skew.per_key_join(detail, per, ["k"], "left", hot_rows=10)
    assert left.filter("m IS NULL").count() == 1 and left.count() == 42


def test_both_sides_of_a_hot_key_are_dealt_to_a_grid(spark):
    left = spark.createDataFrame([("hot", i) for i in range(90)] + [("cold", 1), ("left", 2)], "k string, l int")
    right = spark.createDataFrame([("hot", i) for i in range(70)] + [("cold", 5), ("right", 2)], "k string, r int")
    want = sorted(map(tuple, left.join(right, "k").collect()))
    for block in (7, 80, 1000):
        got = skew.gridded(left, right, ["k"], "l", "r", block)
        assert sorted(map(tuple, got.select("k", "l", "r").collect())) == want
    dealt = skew.gridded(left, right.select("k", "r", F.spark_partition_id().alias("p")), ["k"], "l", "r", 10)
    assert dealt.columns == ["k", "l", "r", "p"]


def test_a_gram_of_most_titles_is_no_hot_task(spark):
    rng = random.Random(11)
    rows = [("b", f"wind {rng.choice(WORDS)} {rng.randrange(400)} {rng.choice(WORDS)}") for _ in range(300)] + [("b", "wind"), ("b", "winds")]
    df = spark.createDataFrame(rows, "block string, title string").distinct()
    plain = sorted(map(tuple, reconcile.similar_titles(df, ["block"], 0.8).collect()))
    dealt = sorted(map(tuple, reconcile.similar_titles(df, ["block"], 0.8, block_rows=8).collect()))
    assert dealt == plain and len(plain) > 50


def test_titles_of_few_words_meet_only_when_near(spark):
    """Every pair of these shares its rarest grams; those that differ too much never reach the ratio."""
    rng = random.Random(5)
    syllables = ["tion", "er", "the", "ing", "an", "é"]
    words = {"".join(rng.choice(syllables) for _ in range(14)) for _ in range(60)}
    words |= {w[:20] + "x" + w[21:] for w in list(words)[:20]}
    df = spark.createDataFrame([("b", w) for w in sorted(words)], "block string, title string")
    met = {(r["left_title"], r["right_title"]) for r in reconcile.similar_titles(df, ["block"]).collect()}
    near = lambda a, b: difflib.SequenceMatcher(None, a, b).ratio() >= 0.9
    assert met >= {(a, b) for a, b in combinations(sorted(words), 2) if near(a, b) or near(b, a)} and len(met) >= 20
    differ = lambda a, b: sum(((Counter(a) - Counter(b)) + (Counter(b) - Counter(a))).values())
    assert all(differ(a, b) <= (len(a) + len(b)) * 0.1 + 1 for a, b in met)


def unmatched(a, b):
    """Characters outside of a longest common subsequence, by its table."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(last[j - 1] + 1 if x == y else max(last[j], row[-1]))
    return len(a) + len(b) - 2 * row[-1]


@pytest.mark.parametrize("threshold", [0.9, 0.8])
def test_titles_meet_alike_by_grams_and_in_a_grid(spark, threshold):
    """What is returned leaves few characters unmatched, whether a block's titles are few or many."""
    rng = random.Random(3)
    syllables = ["tion", "er", "the", "ing", "an", "é", "oo", "ooo"]
    words = {"".join(rng.choice(syllables) for _ in range(rng.randrange(1, 16))) for _ in range(70)} | {"x", "xy", "tionx", "t" * 300, "t" * 310, "ab" * 150}
    words |= {"".join(rng.choice(syllables) for _ in range(n)) for n in (24, 30, 60, 75)}  # more than a word's characters
    for w in sorted(words):
        changed = list(w)
        for _ in range(rng.randrange(5)):
            i = rng.randrange(len(changed) + 1)
            changed[i:i + rng.randrange(2)] = rng.choice(["", "q", "zz"])
        words.add("".join(changed) or "x")
    rows = [(k, w) for k in ("b", "c", None) for w in sorted(words) if k != "c" or len(w) % 9 == 0]
    df = spark.createDataFrame(rows, "block string, title string").coalesce(2)
    q = 3 if threshold > 0.88 else 1
    want = sorted((k, *sorted((u, w))) for (k, u), (n, w) in combinations(rows, 2)
                  if k and k == n and min(len(u), len(w)) >= q and unmatched(u, w) <= (len(u) + len(w)) * (1 - threshold) + 1e-9)
    for few, block in ((1000, 1000), (1, 1000), (1, 9), (30, 64)):
        got = reconcile.similar_titles(df, ["block"], threshold, few_rows=few, block_rows=block).select("block", "left_title", "right_title")
        assert sorted(map(tuple, got.collect())) == want and len(want) > 30


@pytest.mark.parametrize("few", [1, 100])
def test_titles_that_exchange_letters_are_not_met(spark, few):
    """Letters that change places leave two unmatched each: too many for these titles, though an edit distance counts one and bitmaps none."""
    a = "the wake of wind farms and the loads of large turbines in"
    swapped = list(a)
    for i, j in ((4, 30), (9, 40), (13, 50), (19, 55)):
        swapped[i], swapped[j] = swapped[j], swapped[i]
    b, c = "".join(swapped), a.replace("wind", "wild")
    df = spark.createDataFrame([("b", t) for t in (a, b, c)], "block string, title string")
    met = {(r["left_title"], r["right_title"]) for r in reconcile.similar_titles(df, ["block"], few_rows=few).collect()}
    assert unmatched(a, b) > 11 and met == {tuple(sorted((a, c)))}


def replayed(plan, urls):
    """Merges one after another, as a list of what each copies."""
    held, out = {}, set()
    for i, u in urls:
        held.setdefault(i, set()).add(u)
    for kind, primary, secondary in sorted(plan):
        for u in held.get(secondary, ()):
            out.add((primary, secondary, u))
        held.setdefault(primary, set()).update(held.get(secondary, ()))
    return out


def moved_urls(spark, plan, urls):
    df = spark.createDataFrame(plan, "kind string, primary string, secondary string").withColumn("place", F.struct("kind", "primary", "secondary"))
    frame = spark.createDataFrame(urls, "identity_key string, url string")
    return {(r["primary"], r["secondary"], r["url"]) for r in reconcile.merge_urls(df, frame).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_urls_of_random_merges_equal_a_walk(spark, seed):
    rng = random.Random(seed)
    names = [f"n{i:02d}" for i in range(14)]
    plan = list({(rng.choice("abc"), *rng.sample(names, 2)) for _ in range(40)})  # cycles, forks, several primaries
    urls = [(n, f"u{i}") for i, n in enumerate(names) if rng.random() < 0.6]
    assert moved_urls(spark, plan, urls) == replayed(plan, urls)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    n, rounds = 3000, []
    plan = [("k", f"p{i + 1:05d}", f"p{i:05d}") for i in range(n)]
    kept = reconcile.best_jumps
    monkeypatch.setattr(reconcile, "best_jumps", lambda j: rounds.append(1) or kept(j))
    got = moved_urls(spark, plan, [("p00000", "u"), ("p02990", "v")])
    assert len(rounds) < 20 and got == replayed(plan, [("p00000", "u"), ("p02990", "v")])


def test_longest_alias_wins_wherever_it_is_filed(spark):
    from ledgerfold.operators.organisations import match_texts

    names = [("university of the sea", "sea"), ("university", "any"), ("the sea", "short"), ("north university of the sea", "north"), ("a b", "ab"), ("b a", "ba")]
    texts = ["North  University of the Sea, dept", "The University of the Sea!", "by the sea", "universities", "a b a", None, "", "university"] + [f"university {i}" for i in range(200)]
    got = {r["text"]: r["org"] for r in match_texts(
        spark.createDataFrame([(t,) for t in texts], "text string"), spark.createDataFrame(names, "alias string, org string")).collect()}
    assert got == {texts[0]: "north", texts[1]: "sea", texts[2]: "short", "a b a": "ab", "university": "any"} | {f"university {i}": "any" for i in range(200)}


def test_previous_value_does_not_depend_on_the_segments(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.choice(["x", "y", None]), f"2024-01-01T{i // 7:02d}", i) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, v string, t string, seq int")
    one = skew.previous_value(df, ["k"], F.lit("all"), ["t", "seq"], "v")
    many = skew.previous_value(df, ["k"], F.col("t"), ["t", "seq"], "v")
    assert sorted(map(str, one.collect())) == sorted(map(str, many.select(one.columns).collect()))


def test_relations_decide_who_survives(spark):
    rel = lambda r, i: {"related_identifiers": [{"relation": r, "identifier": i}]}
    rows = [
        event(1, "10.5072/pre", system="crossref", source=rel("IsPreprintOf", "10.5072/PUB")),
        event(2, "10.5072/pub", system="crossref", source={}),
        event(3, "10.5072/v1", system="datacite", source=rel("IsVersionOf", "10.5072/c")),
        event(4, "10.5072/c", system="zenodo", source=rel("References", "10.5072/pub")),
        event(5, "10.5072/soft", system="zenodo", source=rel("is-identical-to", "https://github.com/Owner/Repo/")),
        event(6, "github|Owner/Repo", system="github", source=rel("IsIdenticalTo", "10.5072/soft")),
    ]
    got = reconcile.declared_pairs(resolve(ledger(spark, rows)), LedgerSpec())
    assert {(r["primary"], r["secondary"], r["kind"]) for r in reconcile.one_per_pair(got).collect()} == {
        ("10.5072/pub", "10.5072/pre", "preprint-pair"), ("10.5072/c", "10.5072/v1", "version-pair"),
        ("10.5072/soft", "github|Owner/Repo", "related-identifier")}


def test_scope_needs_a_route_a_task_or_a_citation(spark):
    rows = [
        event(1, "10.5072/a", system="zenodo", source={}, discovered_via=["community:x"]),
        event(2, "10.5072/b", system="zenodo", source={"extra": {"crossref_references": ["10.5072/A", "10.5072/zz"]}}, discovered_via=["topic:w"]),
        event(3, "10.5072/c", system="zenodo", source={"related_identifiers": [{"relation": "IsCitedBy", "identifier": "doi:10.5072/B"}]}, discovered_via=["topic:w"]),
        event(4, "10.5072/d", system="zenodo", source={}, discovered_via=["topic:w"]),
        event(5, "10.5072/e", system="zenodo", source={}),
    ]
    resolved = resolve(ledger(spark, rows))
    edges = graph.citation_edges(graph.stated_citations(resolved), graph.alias_index_scope(resolved))
    got = {r["identity_key"][-1]: (r["inclusion_basis"], r["inclusion_evidence"]) for r in graph.decide_scope(resolved, edges, ["topic:w"]).collect()}
    assert {k: v[0] for k, v in got.items()} == {"a": "direct", "b": "cites", "c": "cited-by", "d": "none", "e": "unassessed"}
    assert got["b"][1] == "Cites 10.5072/a and 10.5072/c, which the catalogue holds."
    assert sorted(map(tuple, edges.collect())) == [("10.5072/b", "10.5072/a"), ("10.5072/b", "10.5072/c")]


def test_annotations_wait_apply_once_and_open_identities(spark):
    docs = [
        ("a.json", '{"identity_key":"k1","annotations":[{"local":{"task":["Task 043"]}},{"local":{"task":["task-43"]}}]}'),
        ("b.json", '{"identity_key":"new","annotations":[{"local":{"pinned":true}},{"local":{"suppressed":true},"allow_new":true},{"local":{"pinned":true}}]}'),
        ("c.json", '{"identity_key":"k1","annotations":[{"local":{"title":"x"}}]}'),
        ("d.json", "not json"), ("e.json", '{"identity_key":"k1","annotations":[{"local":{"pinned":true},"source":{}}]}'),
    ]
    files = spark.createDataFrame(docs, "path string, doc string").withColumn("doc", F.try_parse_json("doc"))
    rows, rejects = curation.parse_annotations(files)
    assert {r["path"] for r in rejects.collect()} == {"c.json", "d.json", "e.json"}
    marked = rows.withColumn("fingerprint", curation.fingerprint(F.col("identity_key"), F.col("local"), F.col("actor"), F.col("note")))
    known = spark.createDataFrame([("k1",)], "identity_key string")
    plan = curation.plan_annotations(marked, known, marked.limit(0))
    got = {(r["path"], r["pos"]["entry_pos"]): r["outcome"] for r in plan.collect()}
    assert got == {("a.json", 0): "applied", ("a.json", 1): "skipped", ("b.json", 0): "pending", ("b.json", 1): "applied", ("b.json", 2): "applied"}
    events = curation.annotation_events(plan.filter("outcome = 'applied'"), F.lit("2024"))
    again = curation.plan_annotations(marked, known, curation.recorded_fingerprints(events))
    assert {r["outcome"] for r in again.filter("path = 'a.json'").collect()} == {"skipped"}
    assert events.filter(F.element_at("provenance", "task")["extraction_method"] == "curator").count() == 1


def test_pin_fires_once_per_observed_page(spark):
    rows = [
        event(1, "p", system="task_pages", source={}, source_key="h1"),
        event(2, "p", "annotated", local={"pinned": True, "pin_source_key": "h1"}),
        event(3, "p", system="task_pages", source={}, source_key="h2"),
    ]
    events = ledger(spark, rows)
    pins = curation.pin_notices(resolve(events), events)
    (n,) = pins.collect()
    assert n["observed_at"] == rows[2]["observed_at"] and '"observed_source_key":"h2"' in n["notice"]
    more = events.unionByName(pins.withColumn("seq", F.lit(9).cast("bigint")))
    assert curation.pin_notices(resolve(more), more).count() == 0


def test_backfill_uses_the_last_stated_doi(spark):
    rows = [
        event(1, "x", system="datacite", source={"doi": "10.5281/zenodo.1"}), event(2, "x", system="crossref", source={"doi": "10.5281/ZENODO.2"}),
        event(3, "y", system="zenodo", source={"doi": "10.5281/zenodo.3"}), event(4, "z", system="osti", source={"doi": "10.2172/1"}),
    ]
    got = changes.backfill_queue(ledger(spark, rows), "zenodo", r"^10\.5281/zenodo\.(\d+)$").collect()
    assert [(r["identity_key"], r["source_id"]) for r in got] == [("x", "2")]
