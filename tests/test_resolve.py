import random
from collections import defaultdict

from pyspark.sql import functions as F

from helpers import event, fold, ledger
from ledgerfold.operators import resolve as rs
from ledgerfold.spec import LedgerSpec

SPEC = LedgerSpec()


def random_rows(seed, n=600, keys=40):
    rng = random.Random(seed)
    systems = ["datacite", "crossref", "zenodo", "github", "mystery", None]
    word = lambda: rng.choice(["", "a", "b", "c", None, [], {}, 7, False])
    rows = []
    for seq in range(n):
        key = f"id{rng.randrange(keys)}"
        at = f"2024-01-{rng.randrange(1, 9):02d}T{rng.randrange(24):02d}:00:00Z"
        kind = rng.choice(["scraped"] * 5 + ["annotated"] * 3 + ["withdrawn", "merge_proposal"])
        system = rng.choice(systems)
        if kind == "scraped":
            source = {f: word() for f in rng.sample(["title", "doi", "url", "version"], 2)}
            source["keywords"] = rng.sample(["k1", "k2", "k3", {"z": 1, "a": 2}], rng.randrange(4))
            source["extra"] = {f: word() for f in rng.sample(["x", "y", "z"], 2)}
            if rng.random() < 0.5:
                source["withdrawn"] = rng.choice([True, False, "true"])
            prov = {f: ("api", rng.choice([None, "zenodo"])) for f in rng.sample(["title", "doi"], 1)}
            rows.append(event(seq, key, at=at, system=system, source=source, source_key=f"t{seq}",
                              prov=prov, discovered_via=rng.sample(["r1", "r2", "r3"], 1)))
        elif kind == "annotated":
            local = {f: word() for f in rng.sample(["title", "doi", "pinned"], 2)}
            local["keywords"] = rng.sample(["k2", "k4"], rng.randrange(3))
            rows.append(event(seq, key, kind, at=at, local=local, prov={"doi": ("curator", None)}))
        elif kind == "withdrawn":
            rows.append(event(seq, key, kind, at=at, system=system))
        else:
            rows.append(event(seq, key, kind, at=at, notice={"other": "x"}))
    return rows


def test_fold_matches_a_sequential_walk_in_any_row_order(spark):
    rows = random_rows(7)
    by_key = defaultdict(list)
    for r in rows:
        by_key[r["identity_key"]].append(r)
    expected = {k: fold(v, SPEC) for k, v in by_key.items()}
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    events = ledger(spark, shuffled).repartition(7)
    got = {r["identity_key"]: r for r in rs.resolve(events, SPEC).collect()}
    assert set(got) == set(expected)
    state = rs.system_state(events, SPEC)
    scalars = rs.compose_scalars(rs.source_fields(state, SPEC), SPEC).unionByName(
        rs.compose_bags(rs.source_fields(state, SPEC), SPEC))
    eff = rs.effective_fields(scalars, rs.local_state(rs.local_fields(events), SPEC))
    notes = defaultdict(list)
    for n in rs.notices(events, eff).collect():
        notes[n["identity_key"]].append((n["type"], n["field"] if n["implicit"] else n["observed_at"]))
    for key, want in expected.items():
        row = got[key]
        assert row["effective"] == want["effective"], key
        assert {f: (p["extraction_method"], p["source_system"])
                for f, p in (row["provenance"] or {}).items()} == want["provenance"], key
        assert row["withdrawn_at"] == want["withdrawn_at"]
        assert (row["first_seen"], row["last_seen"]) == (want["first_seen"], want["last_seen"])
        assert row["source_systems"] == want["systems"]
        assert (row["source_key"], row["source_system"]) == want["last"]
        assert row["event_count"] == want["count"]
        assert row["discovered_via"] == want["routes"]
        assert sorted(notes[key]) == want["notes"]


def test_only_the_system_that_withdrew_can_lift_it(spark):
    rows = [
        event(1, "a", system="zenodo", source={"withdrawn": True}),
        event(2, "a", system="datacite", source={"withdrawn": False}),
        event(3, "b", system="zenodo", source={"withdrawn": True}),
        event(4, "b", system="zenodo", source={"withdrawn": False}),
        event(5, "c", "withdrawn"),
        event(6, "c", system="zenodo", source={"withdrawn": False}),
        event(7, "d", system="zenodo", source={"withdrawn": "true"}),
    ]
    facts = rs.identity_facts(rs.system_state(ledger(spark, rows), SPEC))
    got = {r["identity_key"]: r["withdrawn"] for r in facts.collect()}
    assert got == {"a": True, "b": False, "c": True, "d": False}


def test_worst_ranked_source_lists_its_members_first(spark):
    rows = [
        event(1, "a", system="datacite", source={"source_urls": ["https://d", "https://s"]}),
        event(2, "a", system="github", source={"source_urls": ["https://g", "https://s"]}),
        event(3, "a", "annotated", local={"source_urls": ["https://l", "https://d"]}),
    ]
    row = rs.resolve(ledger(spark, rows), SPEC).first()
    assert row["effective"]["source_urls"] == '["https://g","https://s","https://d","https://l"]'
    assert row["local"]["source_urls"] == '["https://l","https://d"]'


def test_an_annotation_does_not_count_as_seen(spark):
    rows = [event(1, "a", system="zenodo", source={"title": "x"}), event(9, "a", "annotated", local={"pinned": True})]
    row = rs.resolve(ledger(spark, rows), SPEC).first()
    assert row["last_seen"] == rows[0]["observed_at"] and row["event_count"] == 2
    assert row["effective"]["pinned"] == "true"
