import json

from pyspark.sql import functions as F

from helpers import event, ledger
from ledgerfold.operators import curation
from ledgerfold.operators import ledger as lg
from ledgerfold.operators.resolve import resolve
from ledgerfold.plans.runs import Registers, annotate, ingest, materialise, read_proposals, reconcile_ledger, records_table, run, write_proposals
from ledgerfold.spec import LedgerSpec
from ledgerfold.streaming.ingest import append_on_change, keep_queue, queue_table, without_replays
from ledgerfold.streaming.monitor import events_per_window
from ledgerfold.streaming.resolve_stream import resolve_continuously, resolved_now

NOW = "2024-06-01T00:00:00Z"


def registers(spark):
    orgs = spark.createDataFrame(
        [(0, "unattributed", "Unattributed", []), (1, "dtu", "Technical University", ["DTU Wind"]), (2, "zenodo-community", "Z", [])],
        "pos int, name string, title string, aliases array<string>")
    groups = spark.createDataFrame(
        [(0, "task-43", "Task 43 — Digital", None, ["task 43"]), (1, "task-54", "Task 54", None, ["task-19"])],
        "pos int, name string, title string, url string, aliases array<string>")
    return Registers(orgs, groups, ["topic:wind"], r"wind[\s-]*tcp")


def catalogue_rows():
    return [
        event(1, "10.5072/a", system="datacite", source_key="a1", source_id="10.5072/a", source={
            "title": "A study", "doi": "10.5072/a", "url": "https://a.org/1", "license_raw": "CC-BY-4.0", "keywords": ["Lidar", "Søren"],
            "authors": [{"name": "Müller, S.", "affiliation": "DTU Wind"}], "published_date": "2020-05",
            "task": ["task-19", "task-99"], "resource_kind": "publication", "extra": {"task_candidates": ["task-43"], "crossref_references": ["10.5072/B"]}},
            discovered_via=["topic:wind"], prov={"resource_kind": ("llm", None)}),
        event(2, "10.5072/b", system="zenodo", source_key="b1", source={"title": "Cited", "license_raw": "odd words", "source_urls": ["https://b.org"]},
              discovered_via=["topic:wind"]),
        event(3, "osti|7", system="osti", source_key="o1", source={"title": "A  study!", "doi": "10.5072/A", "url": "https://osti.org/7",
              "authors": [{"name": "S. Müller"}], "published_date": "2020"}, discovered_via=["query:x"]),
        event(4, "10.5072/c", system="zenodo", source_key="c1", source={"title": "Lonely", "resource_kind": "software"}, discovered_via=["topic:wind"]),
        event(5, "10.5072/d", system="crossref", source_key="d1", source={"title": "A studdy", "authors": [{"name": "Müller, X"}], "published_date": "2020-01-01",
              "related_identifiers": [{"relation": "IsPreprintOf", "identifier": "https://doi.org/10.5072/B"}]}),
        event(6, "10.5072/c", "withdrawn", system="zenodo"),
    ]


def test_materialise_decides_scope_shapes_and_gates(spark):
    out = materialise(ledger(spark, catalogue_rows()), registers(spark),
                      published=spark.createDataFrame([("gone", "x")], "name string, digest string"))
    rows = {r["identity_key"]: r for r in out.packages.collect()}
    ex = {k: {e["key"]: e["value"] for e in r["extras"]} for k, r in rows.items()}
    a = rows["10.5072/a"]
    assert a["name"] == "doi-10-5072-a" and a["license_id"] == "cc-by" and a["owner_org"] == "dtu"
    assert [g["name"] for g in a["groups"]] == ["task-54"] and json.loads(ex["10.5072/a"]["task"]) == ["task-54", "task-99"]
    assert [t["name"] for t in a["tags"]] == ["lidar", "soren"]
    assert ex["10.5072/a"]["inclusion_basis"] == "direct" and "Attributed to task-19 and task-99" in ex["10.5072/a"]["inclusion_evidence"]
    assert json.loads(ex["10.5072/a"]["provenance"])["resource_type"] == {"extraction_method": "llm", "source_system": "datacite"}
    assert ex["10.5072/b"]["inclusion_basis"] == "cited-by" and ex["10.5072/b"]["license_mapped"] == "false"
    assert ex["10.5072/c"]["inclusion_basis"] == "none" and ex["10.5072/c"]["lifecycle_state"] == "withdrawn"
    assert ex["10.5072/c"]["resource_type"] == "research-software" and ex["10.5072/d"]["inclusion_basis"] == "unassessed"
    assert rows["10.5072/b"]["owner_org"] == "zenodo-community" and rows["10.5072/d"]["owner_org"] == "unattributed"
    assert [e["key"] for e in a["extras"]] == sorted(e["key"] for e in a["extras"])
    assert out.violations.count() == 0
    assert {r["group"] for r in out.notices.collect()} == {"task-99"}
    assert {r["name"]: r["action"] for r in out.actions.collect()}["gone"] == "pruned"


def test_reconcile_applies_once_and_proposes_the_rest(spark, tmp_path):
    path = str(tmp_path / "ledger")
    lg.append_events(ledger(spark, catalogue_rows()), path, "seed", 8)
    regs = registers(spark)
    dry = reconcile_ledger(spark, path, regs, "dry", F.lit(NOW))
    assert {(r["primary"], r["secondary"], r["kind"]) for r in dry.candidates.collect()} == {
        ("10.5072/a", "osti|7", "shared-doi"), ("10.5072/b", "10.5072/d", "preprint-pair"),
        ("10.5072/a", "10.5072/d", "fuzzy-title")}  # one link per pair of titles; osti|7 is under a's title
    assert lg.read_table(spark, path).count() == 6
    assert read_proposals(spark, str(tmp_path / "review")).count() == 0
    write_proposals(dry, str(tmp_path / "review"))
    kept = ["primary", "secondary", "kind", "confidence", "evidence", "automatic"]
    assert sorted(map(tuple, read_proposals(spark, str(tmp_path / "review")).collect())) == sorted(map(tuple, dry.candidates.select(kept).collect()))
    reconcile_ledger(spark, path, regs, "r1", F.lit(NOW), apply=True)
    after = {r["identity_key"]: r for r in resolve(lg.read_table(spark, path)).collect()}
    a, o = after["10.5072/a"], after["osti|7"]
    assert json.loads(a["effective"]["task"]) == ["task-19", "task-99", "task-43"]
    assert a["local"]["merged_from"] == '["osti|7"]' and a["local"]["source_urls"] == '["https://osti.org/7"]'
    assert o["local"]["suppressed"] == "true" and o["local"]["merged_into"] == '"10.5072/a"'
    assert json.loads(o["local"]["links"]) == [{"label": "Catalogued as 10.5072/a", "url": "https://a.org/1"}]
    n = lg.read_table(spark, path).count()
    again = reconcile_ledger(spark, path, regs, "r2", F.lit(NOW), apply=True)
    assert again.plan.count() == 0 and again.proposals.count() == 0 and lg.read_table(spark, path).count() == n


def observations(spark, rows):
    return spark.createDataFrame(
        [(k, s, t, at, n, "{}") for n, (k, s, t, at) in enumerate(rows)],
        "identity_key string, source_system string, source_key string, observed_at string, seq bigint, source string"
    ).withColumn("source_id", F.col("identity_key")).withColumn("discovered_via", F.array(F.lit("r:1"))).withColumn(
        "provenance", F.create_map().cast("map<string,struct<extraction_method:string,model:string,prompt_version:string,confidence:double,source_system:string,pinned:boolean>>"))


MOVES = [("a", "zenodo", t, f"2024-01-01T{i:02d}:00:00Z") for i, t in enumerate(["k1", "k1", "k2", "k1", "k1"])] + [
    ("b", "osti", "z", f"2024-01-02T{i:02d}:00:00Z") for i in range(3)]


def test_only_moves_are_appended_and_a_repeat_appends_nothing(spark, tmp_path):
    path = str(tmp_path / "l")
    outcomes = ingest(spark, observations(spark, MOVES).drop("seq"), path, "one")
    assert outcomes.filter("changed").count() == 4 and lg.read_table(spark, path).count() == 4
    ingest(spark, observations(spark, MOVES).drop("seq"), path, "one")
    assert lg.read_table(spark, path).count() == 4
    late = [("a", "zenodo", "k1", "2024-02-01T00:00:00Z"), ("b", "osti", "y", "2024-02-01T00:00:00Z")]
    ingest(spark, observations(spark, late).drop("seq"), path, "two")
    assert lg.read_table(spark, path).count() == 5


def test_run_reports_and_publishes(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    run(spark, observations(spark, MOVES).drop("seq"), p("l"), p("rec"), p("rep"), registers(spark), "n1", NOW, NOW)
    report = spark.read.json(p("rep")).first()
    assert report["ok"] is True and report["events_appended"] == 4 and report["records_total"] == 2 and report["records_written"] == 2
    out = run(spark, observations(spark, [MOVES[4], MOVES[7]]).drop("seq"), p("l"), p("rec"), p("rep"), registers(spark), "n2", NOW, NOW)
    # the actions compare with the records as they were, and can be read after these are replaced
    assert [r["action"] for r in out.actions.collect()] == ["unchanged", "unchanged"]
    report = spark.read.json(p("rep")).first()
    assert report["records_unchanged"] == 2 and report["events_appended"] == 0
    assert records_table(spark, p("rec")).read().count() == 2


def test_annotations_of_unknown_owners_and_tasks_are_refused(spark, tmp_path):
    path = str(tmp_path / "l")
    lg.append_events(ledger(spark, catalogue_rows()), path, "seed", 4)
    docs = [("a.json", '{"identity_key":"10.5072/a","annotations":[{"local":{"owner_org":"dtu"}},{"local":{"owner_org":"nobody"}}]}'),
            ("b.json", '{"identity_key":"10.5072/b","annotations":[{"local":{"task":["Task 43"]}},{"local":{"task":["task-999"]}}]}'), ("c.json", "{")]
    files = spark.createDataFrame(docs, "path string, doc string").withColumn("doc", F.try_parse_json("doc"))
    rows, rejects = curation.parse_annotations(files)
    for run_name in ("one", "two"):
        notices = annotate(spark, rows, rejects, path, run_name, F.lit(NOW), registers(spark)).collect()
        assert sum(n["type"] == "annotation_error" for n in notices) == 3
        assert any("owner_org nobody is not registered" in n["message"] for n in notices) and any("task-999" in n["message"] for n in notices)
        events = lg.read_table(spark, path).filter("event_type = 'annotated'").collect()
        assert sorted(e["local"] for e in events) == ['{"owner_org":"dtu"}', '{"task":["task-43"]}']


def test_a_failing_stage_is_reported_and_raised(spark, tmp_path, monkeypatch):
    import pytest

    from ledgerfold.plans import runs

    p = lambda n: str(tmp_path / n)
    monkeypatch.setattr(runs, "publish", lambda *a: 1 / 0)
    args = (spark, observations(spark, MOVES).drop("seq"), p("l"), p("rec"), p("rep"), registers(spark), "n1", NOW, NOW)
    with pytest.raises(ZeroDivisionError):
        run(*args)
    assert spark.read.json(p("rep")).first()["ok"] is False and records_table(spark, p("rec")).read() is None
    monkeypatch.setattr(runs, "_report", lambda *a: {}["no report"])
    with pytest.raises(ZeroDivisionError) as failed:
        run(*args)
    assert "report failed too" in failed.value.__notes__[0]


def stream_of(spark, tmp_path, name, frames):
    src = str(tmp_path / name)
    for i, f in enumerate(frames):
        f.coalesce(1).write.mode("overwrite").parquet(f"{src}/part={i}")
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/part=*")


def test_stream_of_observations_equals_the_batch(spark, tmp_path):
    rows = observations(spark, MOVES)
    frames = [rows.filter(F.col("seq") % 8 < 3), rows.filter((F.col("seq") % 8).between(3, 4)), rows.filter(F.col("seq") % 8 > 4)]
    stream = stream_of(spark, tmp_path, "obs", frames)
    path = str(tmp_path / "ledger")
    append_on_change(stream, path, str(tmp_path / "cp"), buckets=8).awaitTermination()
    kept = sorted((r["identity_key"], r["source_key"], r["observed_at"]) for r in lg.read_table(spark, path).collect())
    assert kept == sorted([("a", "k1", MOVES[0][3]), ("a", "k2", MOVES[2][3]), ("a", "k1", MOVES[3][3]), ("b", "z", MOVES[5][3])])


def test_incremental_fold_equals_the_fold_of_everything(spark, tmp_path):
    from test_resolve import random_rows

    rows = random_rows(3, 200, 12)
    path, store = str(tmp_path / "l"), str(tmp_path / "s")
    frames = [ledger(spark, rows[:90]), ledger(spark, rows[90:150]), ledger(spark, rows[150:])]
    for i, f in enumerate(frames):
        lg.append_events(f, path, f"b{i}", 8)
    stream = stream_of(spark, tmp_path, "ev", [f.select("identity_key", "seq") for f in frames])
    resolve_continuously(stream, path, store, str(tmp_path / "cp"), buckets=8).awaitTermination()
    strip = lambda df: sorted((r["identity_key"], str(sorted(r["effective"].items())), r["event_count"], r["withdrawn_at"]) for r in df.collect())
    assert strip(resolved_now(spark, store, 8)) == strip(resolve(ledger(spark, rows), LedgerSpec()))


def test_queue_stream_and_replay_filter(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "u1", "k", "first", "t1"), (2, "u2", "j", "only", "t2"), (3, "u3", "k", "newest", "t3")],
        "seq bigint, url string, cache_key string, reason string, queued_at string")
    stream = stream_of(spark, tmp_path, "q", [rows.filter("seq < 3"), rows.filter("seq = 3")])
    keep_queue(stream, str(tmp_path / "queue"), str(tmp_path / "cq")).awaitTermination()
    got = {r["cache_key"]: (r["url"], r["reason"], r["queued_at"]) for r in queue_table(rows, str(tmp_path / "queue")).read().collect()}
    assert got == {"k": ("u1", "newest", "t1"), "j": ("u2", "only", "t2")}

    obs = observations(spark, [MOVES[0], MOVES[0], MOVES[2], MOVES[3]]).withColumn("ts", F.to_timestamp("observed_at"))
    q = (without_replays(stream_of(spark, tmp_path, "dup", [obs]), "ts").writeStream.format("memory").queryName("dups")
         .option("checkpointLocation", str(tmp_path / "cd")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("dups").count() == 3


def test_window_counts_of_a_stream_equal_the_batch(spark, tmp_path):
    e = spark.createDataFrame([(f"2024-01-0{1 + i % 3} 0{i}:00:00", "s", "scraped") for i in range(9)], "t string, source_system string, event_type string")
    e = e.select(F.to_timestamp("t").alias("ts"), "source_system", "event_type")
    q = (events_per_window(stream_of(spark, tmp_path, "w", [e]), "ts").writeStream.format("memory").queryName("wins").outputMode("complete")
         .option("checkpointLocation", str(tmp_path / "cw")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("wins").collect())) == sorted(map(tuple, events_per_window(e, "ts").collect()))


def test_pages_of_one_address_are_checked_apart(spark):
    from ledgerfold.operators import reports

    urls = spark.createDataFrame([("a", "u", 1), ("b", "u", 2), ("b", "u", 2), ("c", "v", 3)], "name string, url string, page_id int")
    checked = spark.createDataFrame([(1, "u", True), (2, "u", False), (3, "v", False)], "page_id int, url string, ok boolean").withColumn("skipped", F.lit(False))
    dead = reports.dead_by_record(urls, reports.dead_links(checked), check="page_id")
    assert sorted((r["name"], r["url"], r["page_id"]) for r in dead.collect()) == [("b", "u", 2), ("c", "v", 3)]


def test_notices_tell_checks_of_one_address_apart(spark):
    from ledgerfold.operators import reports

    urls = spark.createDataFrame([("a", "u", 1), ("b", "u", 2)], "name string, url string, page_id int")
    checked = spark.createDataFrame([(1, "u", 200, True), (2, "u", 404, False)], "page_id int, url string, status_code int, ok boolean").withColumns(
        {"skipped": F.lit(False), "error": F.lit(None).cast("string"), "gone": F.lit(True)})
    by_record = reports.dead_by_record(urls, reports.dead_links(checked), check="page_id")
    found = reports.link_notices(by_record, checked, reports.unreachable_hosts(checked), check="page_id")
    assert [(r["record"], r["url"], r["status_code"]) for r in found.filter("type = 'dead_link'").collect()] == [("b", "u", 404)]


def test_sightings_keep_all_contents_of_one_address(spark):
    from ledgerfold.operators import pages

    rows = spark.createDataFrame(
        [("d", "u", "h2", "t2"), ("d", "u", "h1", "t1"), ("d", "v", "h1", None), ("e", "u", "h3", "t1")], "doi string, url string, content_hash string, task string")
    got = {r["doi"]: (r["tasks"], r["pages"], r["hashes"]) for r in pages.doi_sightings(rows).collect()}
    assert got == {"d": (["t1", "t2"], ["u", "v"], ["h1", "h2"]), "e": (["t1"], ["u"], ["h3"])}
