"""Keyed tables, keyed streaming state, the incremental citation graph, publication and names."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from helpers import event, ledger
from ledgerfold.operators import graph
from ledgerfold.operators import ledger as lg
from ledgerfold.operators.resolve import resolve
from ledgerfold.sources import keyed
from ledgerfold.sources.keyed import KeyedTable, named_once, publish
from ledgerfold.streaming.ingest import append_on_change, place_moves
from ledgerfold.streaming.resolve_stream import CitationGraph, refresh_identities, resolved_table
from test_runs import observations, stream_of


def rows_of(table, **more):
    return sorted(map(tuple, table.read(**more).collect()))


def files(tmp_path):
    return [p for p in tmp_path.rglob("*.parquet")]


# -- keyed tables ------------------------------------------------------------------------------------------


def test_newest_row_of_a_key_counts_and_files_stay_few(spark, tmp_path):
    table, want = KeyedTable(spark, str(tmp_path / "t"), "k", 2), {}
    counts = []
    for batch in range(10):
        fresh = {f"k{(batch * 3 + i) % 7}": batch for i in range(3)}
        want |= fresh
        table.merge(spark.createDataFrame(list(fresh.items()), "k string, v int").coalesce(1), "w", batch)
        counts.append(len(files(tmp_path)))
        assert rows_of(table) == sorted(want.items())
    assert max(counts[-4:]) <= max(counts[3:6]) + 4 and len(table.versions()) == keyed.KEEP
    # a batch that comes again changes nothing
    before = table.entry()
    table.merge(spark.createDataFrame([("k0", -1)], "k string, v int"), "w", 9)
    assert table.entry() == before


def test_a_reader_keeps_its_version_and_a_killed_write_is_not_seen(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", 1)
    one = lambda v: spark.createDataFrame([("a", v)], "k string, v int")
    table.merge(one(0), "w", 0)
    old = table.entry()
    reader = table.read(old)
    for v in (1, 2):
        table.merge(one(v), "w", v)
    assert reader.collect() == [("a", 0)] and rows_of(table) == [("a", 2)]
    # files of a write that died before its entry
    one(9).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(str(tmp_path / "t" / "version=4"))
    assert rows_of(table) == [("a", 2)]
    table.merge(one(3), "w", 3)
    assert rows_of(table) == [("a", 3)]
    assert table.before("w", 3).done == {"w": 2}


def test_two_writers_of_one_version_do_not_hide_each_other(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", 1)
    table.merge(spark.createDataFrame([("a", 0)], "k string, v int"))
    with pytest.raises(RuntimeError):
        table._write(table.entry())
    assert KeyedTable(spark, str(tmp_path / "none"), "k").read() is None


def test_publication_writes_changed_buckets_only(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "name", 8)
    rows = lambda change: spark.createDataFrame([(f"n{i}", f"{i}{change if i == 5 else ''}") for i in range(40)], "name string, x string").withColumn(
        "digest", F.sha2("x", 256))
    assert {r["action"] for r in publish(table, rows("")).collect()} == {"written"}
    before = table.entry()
    actions = {r["name"]: r["action"] for r in publish(table, rows("!")).collect()}
    assert [n for n, a in actions.items() if a == "written"] == ["n5"] and len(actions) == 40
    after = table.entry()
    assert sum(before.buckets[b] != after.buckets[b] for b in before.buckets) == 1
    assert sorted(r["x"] for r in table.read().collect())[:3] == sorted([f"{i}{'!' if i == 5 else ''}" for i in range(40)])[:3]
    # nothing changed: no new files; a crash before the entry leaves the table as it was
    assert {r["action"] for r in publish(table, rows("!")).collect()} == {"unchanged"}
    assert table.entry().buckets == after.buckets
    gone = publish(table, rows("!").filter("name = 'n5'"))
    assert sum(r["action"] == "pruned" for r in gone.collect()) == 39 and table.read().count() == 1


def test_a_name_never_moves(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "n"), "identity_key", 4)
    frame = lambda rows: spark.createDataFrame(rows, "identity_key string, first_seq long")
    first = {r["identity_key"]: r["slug"] for r in named_once(table, frame([("x|A b", 5), ("x|c", 6)])).collect()}
    assert first == {"x|A b": "x-a-b", "x|c": "x-c"}
    # "x|a b" is older, but comes later; of two newcomers with one plain name the earliest has it
    more = [("x|A b", 5), ("x|a b", 1), ("x|D", 9), ("x|d", 8)]
    for _ in range(2):
        got = {r["identity_key"]: r["slug"] for r in named_once(table, frame(more)).collect()}
        assert got["x|A b"] == "x-a-b" and got["x|a b"].startswith("x-a-b-") and got["x|d"] == "x-d" and got["x|D"].startswith("x-d-")
    assert table.read().count() == 5
    assert named_once(KeyedTable(spark, str(tmp_path / "e"), "identity_key"), frame([])).count() == 0


# -- keyed state -------------------------------------------------------------------------------------------


def test_rows_take_their_place_among_known_moves():
    moved, known = place_moves([], [("1", 0, "a"), ("2", 1, "a"), ("3", 2, "b"), ("4", 3, "a"), ("4", 4, None), ("5", 5, None)])
    assert moved == [True, False, True, True, True, False] and [m[2] for m in known] == ["a", "b", "a", None]
    late, known = place_moves(known, [("2", 9, "a"), ("2", 10, "c"), ("0", 11, "a"), ("0", 12, "z")])
    assert late == [False, True, False, True] and [m[2] for m in known] == ["z", "a", "c", "b", "a", None]
    assert len(place_moves([], [(str(i), i, str(i)) for i in range(100)], 8)[1]) == 8


def test_moves_over_restarts_read_the_ledger_once(spark, tmp_path):
    path, cp = str(tmp_path / "ledger"), str(tmp_path / "cp")
    seed = observations(spark, [("a", "zenodo", "k0", "2023-01-01T00:00:00Z")])
    lg.append_events(lg.scrape_events(seed), path, "seed", 4)
    tokens = ["k0", "k1", "k2", "k1"]
    src, seen = tmp_path / "obs", []
    for i, token in enumerate(tokens):
        row = observations(spark, [("a", "zenodo", token, f"2024-01-01T{i:02d}:00:00Z")]).withColumn("seq", F.lit(10 + i).cast("bigint"))
        row.coalesce(1).write.parquet(f"{src}/part={i}")
        stream = spark.readStream.schema(row.schema).parquet(f"{src}/part=*")
        query = append_on_change(stream, path, cp, buckets=4)
        query.awaitTermination()
        seen += [p for p in query.recentProgress if p["numInputRows"]]
    got = sorted((r["observed_at"], r["source_key"]) for r in lg.read_table(spark, path).collect())
    assert [k for _, k in got] == ["k0", "k1", "k2", "k1"]
    assert len(seen) == len(tokens) and all(len(p["sources"]) == 1 and p["numInputRows"] == 1 for p in seen)
    # a late observation is placed by its time: after k1 of hour 1 it is a move, like k1 it is none
    for i, (token, hour) in enumerate([("k1", "01:30"), ("k9", "01:45")]):
        row = observations(spark, [("a", "zenodo", token, f"2024-01-01T{hour}:00Z")]).withColumn("seq", F.lit(50 + i).cast("bigint"))
        row.coalesce(1).write.parquet(f"{src}/part=9{i}")
    append_on_change(spark.readStream.schema(row.schema).parquet(f"{src}/part=*"), path, cp, buckets=4).awaitTermination()
    got = sorted((r["observed_at"], r["source_key"]) for r in lg.read_table(spark, path).collect())
    assert [k for _, k in got] == ["k0", "k1", "k9", "k2", "k1"]


# -- the citation graph ------------------------------------------------------------------------------------


def random_citations(r, n, people=12):
    rows = []
    for i in range(n):
        key = f"10.5072/{r.choice('abcdefgh')}" if r.random() < 0.5 else f"osti|{r.randrange(people)}"
        targets = [r.choice(["10.5072/" + r.choice("abcdefgh"), f"OSTI|{r.randrange(people)}", "10.5072/nobody"]) for _ in range(r.randrange(3))]
        source = {"title": f"t{i}", "related_identifiers": [{"relation": r.choice(["Cites", "IsCitedBy", "Other"]), "identifier": t} for t in targets]}
        if r.random() < 0.4:
            source["doi"] = "10.5072/" + r.choice("abcdefghxyz")
        if r.random() < 0.1:
            source["task"] = ["task-1"]
        rows.append(event(i + 1, key, system=r.choice(["zenodo", "osti"]), source=source, source_key=str(i), discovered_via=["topic:wind"]))
    return rows


def test_graph_of_batches_equals_the_graph_of_everything(spark, tmp_path):
    rows = random_citations(random.Random(1), 36, 6)
    path, store = str(tmp_path / "l"), str(tmp_path / "s")
    kept = CitationGraph(spark, f"{store}/graph", ["topic:wind"], buckets=1)
    for batch, at in enumerate(range(0, 36, 12)):
        part = ledger(spark, rows[at : at + 12])
        lg.append_events(part, path, f"b{batch}", 1)
        for _ in range(2 if batch == 1 else 1):  # a batch that is repeated comes to the same end
            fresh = refresh_identities(spark, part, path, store, batch, buckets=1)
            kept.update(fresh, resolved_table(spark, store, 1), batch)
    whole = resolve(ledger(spark, rows))
    edges = graph.citation_edges(graph.stated_citations(whole), graph.alias_index_scope(whole))
    assert sorted((e["src"], e["dst"]) for e in kept.standing_edges().collect()) == sorted(map(tuple, edges.collect()))
    want = sorted(map(tuple, graph.decide_scope(whole, edges, ["topic:wind"]).collect()))
    assert sorted(map(tuple, kept.scope.read().collect())) == want and {w[1] for w in want} >= {"direct", "cites"}
    assert json.dumps(sorted(kept.scope.entry().done.items())) == '[["resolve", 2]]'


def test_a_batch_that_died_between_two_tables_is_made_good(spark, tmp_path, monkeypatch):
    rows = random_citations(random.Random(7), 20, 5)
    path, store = str(tmp_path / "l"), str(tmp_path / "s")
    kept = CitationGraph(spark, f"{store}/graph", [], buckets=1)
    for batch, at in enumerate((0, 10)):
        part = ledger(spark, rows[at : at + 10])
        lg.append_events(part, path, f"b{batch}", 1)
        fresh = refresh_identities(spark, part, path, store, batch, buckets=1)
        if batch:
            with monkeypatch.context() as m:
                m.setattr(kept.edges, "merge", lambda *a: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    kept.update(fresh, resolved_table(spark, store, 1), batch)
        kept.update(fresh, resolved_table(spark, store, 1), batch)
    whole = resolve(ledger(spark, rows))
    edges = graph.citation_edges(graph.stated_citations(whole), graph.alias_index_scope(whole))
    assert sorted((e["src"], e["dst"]) for e in kept.standing_edges().collect()) == sorted(map(tuple, edges.collect()))


def test_parts_of_many_files_stay_one_batch_each(spark, tmp_path, monkeypatch):
    from ledgerfold.plans.stream_queries import arriving

    monkeypatch.setattr("ledgerfold.plans.stream_queries.scratch", lambda _: str(tmp_path / "in"))
    parts, seen = [spark.range(0, 40, numPartitions=3), spark.range(40, 70), spark.range(70, 101, numPartitions=1)], []
    stream = arriving([p.toDF("n") for p in parts], file_rows=10)
    keep = lambda batch, i: seen.append(sorted(r["n"] for r in batch.collect()))
    stream.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert seen == [list(range(0, 40)), list(range(40, 70)), list(range(70, 101))]
    assert [len(list(tmp_path.glob(f"in/part={i}/*.parquet"))) for i in range(3)] == [3, 3, 3]


def test_moves_are_one_value_of_a_key(spark):
    from ledgerfold.streaming.ingest import Moves

    class Held:
        value, reads, writes = None, 0, 0

        def get(self):
            self.reads += 1
            return self.value

        def update(self, value):
            self.value, self.writes = value, self.writes + 1

    moves = Moves()
    moves.state = held = Held()
    moves.handleInitialState(("a", "s"), {"observed_at": "1", "seq": 1, "source_key": "x"}, None)
    rows = [{"observed_at": t, "seq": n, "source_key": k, "row": k + t} for t, n, k in (("3", 3, "y"), ("2", 2, "x"), ("4", 4, "y"))]
    assert [r["row"] for r in moves.handleInputRows(("a", "s"), iter(rows), None)] == ["y3"]
    assert held.value == (["1", "3"], [1, 3], ["x", "y"]) and (held.reads, held.writes) == (1, 2)


def test_the_ledger_is_aggregated_once_for_few_and_for_many_touched(spark, tmp_path, monkeypatch):
    from ledgerfold.streaming import resolve_stream as rs

    rows = random_citations(random.Random(3), 30, 6)
    path, asked, folded = str(tmp_path / "l"), [], []
    lg.append_events(ledger(spark, rows), path, "b0", 2)
    state, fold = rs.system_state, rs.resolve
    monkeypatch.setattr(rs, "system_state", lambda events, *a: asked.append(events) or state(events, *a))
    monkeypatch.setattr(rs, "resolve", lambda *a: folded.append(a[2]) or fold(*a))
    whole = resolve(ledger(spark, rows))
    keys = sorted(r[0] for r in whole.select("identity_key").collect())[::2]
    plain = lambda df: sorted((r["identity_key"], r["event_count"], r["source_key"], sorted(r["effective"].items()), r["discovered_via"]) for r in df.collect())
    want = plain(whole.filter(F.col("identity_key").isin(keys)))
    for few in (0, 1000):
        touched = spark.createDataFrame([(k,) for k in keys * 2], "identity_key string")
        assert plain(refresh_identities(spark, touched, path, str(tmp_path / f"s{few}"), 0, buckets=2, few_keys=few)) == want
        assert plain(resolved_table(spark, str(tmp_path / f"s{few}"), 2).read()) == want
    assert len(asked) == len(folded) == 2
    joins = [e._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") for e in asked]
    assert joins == [0, 1]  # many touched: no event moves for the join


def test_a_batch_reads_what_was_appended_until_then(spark, tmp_path, monkeypatch):
    from ledgerfold.plans import stream_queries as sq
    from ledgerfold.streaming import resolve_stream as rs

    rows, seen = random_citations(random.Random(5), 24, 6), []
    refresh = rs.refresh_identities

    def kept(spark, touched, path, store, batch, *a):
        fresh = refresh(spark, touched, path, store, batch, *a)
        seen.append((batch, sorted(map(tuple, fresh.select("identity_key", "event_count").collect()))))
        return fresh

    monkeypatch.setattr(rs, "refresh_identities", kept)
    store = sq.followed([ledger(spark, rows[:10]), ledger(spark, rows[10:])], generic_routes=[])
    for part, (batch, states) in enumerate(seen):
        held = rows[: (10, 24)[part]]
        touched = {r["identity_key"] for r in (rows[:10], rows[10:])[part]}
        assert batch == part and states == sorted((k, sum(r["identity_key"] == k for r in held)) for k in touched)
    assert len(seen) == 2
    whole = resolve(ledger(spark, rows))
    edges = graph.citation_edges(graph.stated_citations(whole), graph.alias_index_scope(whole))
    kept_edges = CitationGraph(spark, f"{store}/graph", [], buckets=sq.FEW).standing_edges()
    assert sorted((e["src"], e["dst"]) for e in kept_edges.collect()) == sorted(map(tuple, edges.collect()))
