import json
import tempfile
import random

import pytest
from pyspark.sql import functions as F

from ledgerfold.functions import html
from ledgerfold.functions import text as tx
from ledgerfold.functions.html import html_to_text, sanitise_each, sanitise_html, texts_of_each
from ledgerfold.functions.jsonval import quote
from ledgerfold.functions.urls import safe_url
from ledgerfold.operators import classify, intake, ledger, licences, packages, pages, quality
from ledgerfold.sources import registers
from ledgerfold.sources.observation import LISTINGS, _spelling, mapped_licence, read_listing


def each(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in sorted(df.select("i", fn(F.col("v")).alias("o")).collect())]


def test_doi_spellings(spark):
    cases = {
        "https://doi.org/10.5072/ZENODO.123.": "10.5072/zenodo.123", "DOI 10.5072/x": "10.5072/x", "doi: 10.5072/ x": "10.5072/x",
        "10.5072/zenodo.45/": "10.5072/zenodo.45", "https://doi.org/10.1002/we.2745#abstract": "10.1002/we.2745",
        "doi:https://dx.doi.org/10.5072/a?x=1": "10.5072/a", "10.5072/((a)": "10.5072/((a)", "10.5072/a(1)": "10.5072/a(1",
        "<10.5072/a>": "10.5072/a", "10.5072/": None, "11.5072/a": None, "": None, None: None, "10.5072/s[1": "10.5072/s[1",
    }
    assert each(spark, tx.normalise_doi, list(cases)) == list(cases.values())


def test_dois_of_a_text_are_rejoined_and_distinct(spark):
    text = "see doi:10.5072/abc-\n def, et al.\nSmith; https://doi.org/10.5072/ABC-def. (10.5072/x.\n12)"
    assert each(spark, tx.extract_dois, [text, None]) == [["10.5072/abc-def", "10.5072/x.12"], []]


def test_slugs_fold_and_stay_short(spark):
    long = "10.5072/" + "x" * 120
    a, b, c, d = each(spark, tx.slug_for_identity, ["zenodo|12", "hash|ab", long, "漢字"])
    assert (a, b, d) == ("zenodo-12", "hash-ab", "record") and len(c) == 100 and c[-9] == "-"
    assert each(spark, tx.slugify, ["Søren Ø. Müller"]) == ["soren-o-muller"]
    assert each(spark, tx.tagify, ["Søren Æ", "x", "a--b", "½ ﬁn"]) == ["soren-ae", "", "a-b", "12-fin"]


def test_tasks_titles_authors_and_dates(spark):
    assert each(spark, tx.normalise_task, [" Task 043 ", "TASK_7", "Odd  Name", None]) == ["task-43", "task-7", "odd name", ""]
    assert each(spark, tx.normalise_author, ["Müller, Søren", "Søren Müller", "van der Berg, A", ""]) == ["muller", "muller", "vanderberg", ""]
    assert each(spark, tx.human_date, ["2024", "2024-06", "2024-06-01", "soon", None]) == ["2024", "June 2024", "1 June 2024", "soon", ""]


def test_json_literals_round_trip(spark):
    values = ["null", "[]", "a]", "[b", 'q"uote', "é\n", "", None]
    assert [None if o is None else json.loads(o) for o in each(spark, quote, values)] == values


@pytest.mark.parametrize("url,ok", [
    ("https://e.org/x", True), ("mailto:a@b", True), ("javascript:alert(1)", False), ("\x01javascript:a", False),
    ("java\tscript:a", False), ("java\x0bscript:a", False), ("data:text/html,x", False), ("//h/x", False), ("rel/x", False), ("", False)])
def test_link_schemes(spark, url, ok):
    assert (each(spark, lambda c: safe_url(c), [url])[0] is not None) == ok


def test_html_reduction(spark):
    html = "<div><p>Hi <b>x<script>bad()</script> &amp; <a href='javascript:1' title='q'>l</a><br><i onclick=x>e</div>"
    assert each(spark, sanitise_html, [html, None]) == [
        '<p>Hi <b>x &amp; <a title="q">l</a><br /><i>e</i></b></p>', ""]
    assert each(spark, html_to_text, ["<p>a  b</p><p>c</p><style>z</style>&lt;"]) == ["a b\n\nc\n<"]


def test_texts_of_a_list_are_cleaned_one_by_one(spark):
    lists = [["<script>x", "Abstract text"], ["<p>one", "two"], ["a > b", None], [], None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, v array<string>")
    out = [tuple(r) for r in df.orderBy("i").select(sanitise_each("v"), texts_of_each("v")).collect()]
    assert out == [(["", "Abstract text"], ["", "Abstract text"]), (["<p>one</p>", "two"], ["one", "two"]), (["a &gt; b", ""], ["a > b", ""]),
                   ([], []), (None, None)]


def test_markup_that_is_odd(spark):
    cases = {
        '<a href="x" title=\'q"\'>l</a>': '<a href="x" title="q&quot;" rel="nofollow noopener">l</a>', "a < b": "a &lt; b",
        "<b>x<i>y</b>z": "<b>x<i>y</i></b>z", "</p>x<br/>": "x<br />", "<!-- <b> -->k": "k", "<svg><b>n</b></svg>m": "m", "<td colspan=2>c": '<td colspan="2">c</td>',
        "&lt;b&gt; &amp;amp;": "&lt;b&gt; &amp;amp;",
    }
    assert each(spark, sanitise_html, list(cases)) == list(cases.values())


def test_licences_map_by_spelling_url_and_bare_version(spark):
    raw = ["CC-BY-4.0", "https://creativecommons.org/licenses/by-nd/4.0/", "Apache License, Version 2.0", "GPL-2.0-only", "mit 1.2", "odd", "", None]
    want = [("cc-by", True), ("cc-by-nd", True), ("apache", True), ("gpl-2.0", True), ("mit", True), ("notspecified", False),
            ("notspecified", True), ("notspecified", True)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "i int, r string")
    out = licences.map_licences(df, "r", registers.licence_aliases(spark))
    assert [(r["license_id"], r["license_mapped"]) for r in sorted(out.collect(), key=lambda r: r["i"])] == want
    assert each(spark, mapped_licence, raw) == [w[0] for w in want]
    assert each(spark, licences.normalise_licence, raw[:6]) == [_spelling(t) for t in raw[:6]]


def test_titles_name_a_type_only_in_type_position(spark):
    phrases = {"recommended practice": "recommended-practice", "best practice": "best-practice", "best practices": "best-practice"}
    t = lambda c: classify.title_type(c, r"wind[\s-]*tcp", phrases)
    cases = {
        "Wind TCP Recommended practice 13: Ice": "recommended-practice", "Recommended Practice: Ontology": "recommended-practice",
        "Ontologies – Recommended Practice": "recommended-practice", "Wind TCP Task 43 Joint Best Practice on X": "best-practice",
        "Wind TCP Task 32: best practices for the certification": None, "Definition of Best Practice for Testing": None, None: None,
    }
    assert each(spark, t, list(cases)) == list(cases.values())


def test_relative_links(spark):
    base = F.lit("https://h.org/a/b/c?q=1#f")
    cases = {"x": "https://h.org/a/b/x", "../x": "https://h.org/a/x", "/x": "https://h.org/x", "//o.org/x": "https://o.org/x",
             "?z": "https://h.org/a/b/c?z", "mailto:a@b": "mailto:a@b", "./x?u=../y": "https://h.org/a/b/x?u=../y"}
    assert each(spark, lambda c: pages.absolute_url(base, c), list(cases)) == list(cases.values())


def test_payload_rules_of_the_write_path(spark):
    body = json.dumps({"title": "t" * 70000, "n": None, "url": "x:y", "keywords": list(range(600)), "links": [{"url": "http://b", "label": "l"}, {"label": "z"}],
                       "related_identifiers": [{"url": "bad:1", "identifier": "i"}, 3], "task": ["Task 01", "task-1"], "source_urls": [" http://a ", "x:y", "http://a"]})
    out = json.loads(each(spark, lambda c: ledger.sanitise_payload(c), [body])[0])
    assert out["title"] == "t" * 70000 and out["n"] is None and out["url"] is None
    assert len(out["keywords"]) == 600 and out["links"] == [{"url": "http://b", "label": "l"}]
    assert out["related_identifiers"] == [{"identifier": "i"}] and out["task"] == ["task-1"] and out["source_urls"] == ["http://a"]
    assert set(out) == set(json.loads(body))


def test_records_listings_and_state_files(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.json").write_text('{"name":"a"}')
    (tmp_path / "r" / "b.json").write_text("[1]")
    (tmp_path / "r" / "c.json").write_text("{")
    rows, bad = packages.read_records(spark, str(tmp_path / "r"))
    assert rows.count() == 1 and {r["message"] for r in bad.collect()} == {"invalid JSON", "top level must be an object"}
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "p.json").write_text('[{"osti_id":"1"},{"osti_id":"2"},3]')
    (tmp_path / "l" / "q.json").write_text('{"records":[{"osti_id":"4"}]}')
    got = read_listing(spark, str(tmp_path / "l"), *LISTINGS["osti"])
    assert {r["source_id"] for r in got.collect()} == {"1", "2", "4"}
    from ledgerfold.operators import reports

    assert reports.read_state(spark, str(tmp_path / "none"), "finished_at string").count() == 0
    fresh = reports.freshness(reports.read_state(spark, str(tmp_path / "none"), "finished_at string"), F.lit("2024-01-01").cast("timestamp")).first()
    assert fresh["never_run"] and not fresh["stale"]


def test_jsonl_logs_are_numbered_across_splits(spark, tmp_path):
    for u in "ab":
        lines = [f'{{"identity_key":"zenodo|{u}","observed_at":"2024-01-0{1 + i % 3}","event_type":"scraped","source":{{"n":{i}}}}}' for i in range(300)]
        lines[7] = "{cut"
        lines[9] = ""
        (tmp_path / f"zenodo-{u}.jsonl").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 5000)
    try:
        events, problems = ledger.read_ledger(spark, str(tmp_path))
        got = {(r["identity_key"], r["seq"]): r["source"] for r in events.collect()}
        assert len(got) == 596 and all(json.loads(s)["n"] == seq - 1 for (_, seq), s in got.items())
        assert {(r["path"], r["line"], r["reason"]) for r in problems.collect()} == {
            (f"zenodo-{u}.jsonl", 8, "malformed event line") for u in "ab"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_log_line_is_parsed_once_in_each_pass(spark):
    rows = [("/l/a-1.jsonl", 1, '{"identity_key":"a|1","observed_at":"t","event_type":"scraped"}'), ("/l/a-1.jsonl", 2, " "),
            ("/l/a-1.jsonl", 3, None), ("/l/a-1.jsonl", 4, '{"identity_key":"a|2","observed_at":"t","event_type":"scraped"}'), ("/l/a-1.jsonl", 5, "{")]
    raw = spark.createDataFrame(rows, "path string, line_no long, said string").repartition(3)
    lines = raw.select("path", "line_no", F.concat("said", F.lit("")).alias("line"))
    events, problems = ledger.parse_events(lines)
    plan = events.select("identity_key", "seq")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(") == 2  # for the owners of the files and for the events; no filter writes it out again
    assert [(r["identity_key"], r["seq"]) for r in events.collect()] == [("a|1", 1)]
    assert sorted((r["line"], r["reason"]) for r in problems.collect()) == [(4, "event belongs to another identity"), (5, "malformed event line")]


def test_vocabulary_gate_and_labels(spark):
    vocab = spark.createDataFrame(
        [("resource_kind", k, None, "d", None) for k in ("dataset", "publication", "software", "report", "model", "strange")]
        + [("resource_type", "dataset", "nokind", "", "who")], "section string, name string, kind string, definition string, authority string")
    messages = [r["message"] for r in quality.vocabulary_problems(vocab, spark.createDataFrame([("me",)], "name string")).collect()]
    assert "resource_kind other can be produced but is not defined" in messages
    assert "resource_kind strange is defined but unknown here" in messages
    assert "resource_type dataset names unknown kind nokind" in messages and "resource_type dataset has no definition" in messages
    assert "resource_type dataset names unknown authority who" in messages
    rows = registers.labelled(spark.createDataFrame([("a",), ("b",)], "g string"), "g",
                              spark.createDataFrame([("a", "Task 25/63 — Long")], "name string, title string"), "label")
    assert {r["g"]: r["label"] for r in rows.collect()} == {"a": "Task 25/63 — Long", "b": "b"}
    assert each(spark, registers.short_title, ["Task 25/63 — Long", "x"]) == ["Task 25/63", "x"]


def test_badges_prefer_a_concept_that_resolves(spark):
    related = lambda d: json.dumps({"data": {"attributes": {"relatedIdentifiers": [
        {"relationType": "IsVersionOf", "relatedIdentifierType": "DOI", "relatedIdentifier": d}]}}})
    answers = spark.createDataFrame([("10.5072/v1", "datacite", 200, related("10.5072/C1")), ("10.5072/c1", "datacite", 200, "{}"),
                                     ("10.5072/v2", "datacite", 200, related("10.5072/c2"))], "doi string, agency string, status int, payload string")
    readmes = spark.createDataFrame([(1, "x https://zenodo.org/badge/DOI/10.5072/v1.svg"), (2, "[b](zenodo.org/badge/10.5072/gone.svg) https://zenodo.org/badge/10.5072/v2.svg"),
                                     (3, "cites 10.5072/v1")], "repo int, readme string")
    got, drops = intake.resolve_badges(intake.badge_candidates(readmes, "repo"), answers, "repo")
    assert {(r["repo"], r["doi"], r["version_doi"]) for r in got.collect()} == {(1, "10.5072/c1", "10.5072/v1"), (2, "10.5072/v2", None)}
    assert {r["doi"] for r in drops.collect()} == {"10.5072/gone", "10.5072/c2"}


def test_replay_and_details(spark):
    from helpers import event, ledger as frame
    from ledgerfold.operators import listing
    from test_runs import registers as regs

    rows = [event(1, "zenodo|1", system="zenodo", source={"title": "T", "url": "https://z.org"}, discovered_via=["community:x"]),
            event(2, "zenodo|1", "annotated", local={"links": [{"url": "https://p.org", "label": "Catalogued as 10.5072/p"}], "suppressed": True}),
            event(3, "zenodo|2", system="zenodo", source={"title": "U"})]
    events, r = frame(spark, rows), regs(spark)
    pkg = packages.replay(events, "zenodo|1", r.organisations, r.groups, [])
    row = pkg.first()
    assert row["name"] == "zenodo-1" and listing.listed(pkg).count() == 0
    text = pkg.select(packages.record_json(pkg).alias("t")).first()["t"]
    assert json.loads(text)["title"] == "T" and text.index('"extras"') < text.index('"title"')
    dead = spark.createDataFrame([("zenodo-1", ["https://z.org"])], "name string, urls array<string>")
    page = listing.record_details(pkg, dead, listing.event_history(events)).first()
    assert page["dead_links"] == ["https://z.org"] and [h["event_type"] for h in page["history"]] == ["scraped", "annotated"]
    assert page["merged_into"]["label"] == "10.5072/p" and page["out_of_scope"] is False


@pytest.mark.parametrize(("source", "text", "markup"), [
    ("<p title=it's>Hello one</p><p>it's end</p>", "Hello one\n\nit's end", "<p>Hello one</p><p>it's end</p>"),
    ('<p class="x>Hello</p>', "", ""),
    ('<script title="x>alert(1)</script>', "", ""),
    ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2", "1 &lt; 2 and 3 &gt; 2"),
    ("<a href='x'title=\"y\">z</a>", "z", '<a href="x" title="y" rel="nofollow noopener">z</a>'),
    ("<a title='a>b'>t</a>", "t", '<a title="a&gt;b">t</a>'),
    ("<script>if(a<b)</scripty>x</script>y", "y", "y"),
    ("<p =x a==b c= >z</p >", "z", "<p>z</p>"),
    ("a<i class=>b</i><!-->c<!-- > -- ' -->d</ x>e", "abcde", "a<i>b</i>cde"),
    ("<p/class=a>b", "b", "<p>b</p>"),
])
def test_odd_quotes_lose_no_text_and_show_no_markup(source, text, markup):
    assert (html.readable(source), html.safe_markup(source)) == (text, markup)


def test_text_of_random_markup_equals_the_standard_parser():
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.said = []

        def handle_data(self, data):
            self.said.append(data)

    r = random.Random(4)
    values = ["x", '"a>b"', "'it is'", "it's", "a=b", "/y", '"q"', "''", "&amp;"]
    for _ in range(3000):
        parts = []
        for _ in range(r.randrange(1, 7)):
            attributes = "".join(f" {r.choice('abc')}{r.choice(['', '='])}" if r.random() < 0.2 else f" {r.choice(['id', 'title', 'x-y'])}={r.choice(values)}" for _ in range(r.randrange(3)))
            parts += [r.choice([f"<b{attributes}>", f"<span{attributes} >", "</b>", "</span >", "<!-- c > -->", "<u>", "< ", "&lt;", "'", '"']), r.choice(["t", " word", "1 > 0 ", "it's"])]
        source = "".join(parts)
        plain = Plain()
        plain.feed(source)
        plain.close()
        assert "".join(v for kind, v, _ in html.tokens(source) if kind == "text") == "".join(plain.said), source


def test_every_page_of_an_index_equals_the_sorted_rows(spark, monkeypatch):
    from ledgerfold.operators import listing

    r = random.Random(6)
    titles = ["Éclair", "eclair", "Zebra", "apple", "Äpfel", "äpfel", "Øre", "ore", "zoo"]
    rows = [(f"n{i:03d}", f"20{r.randrange(10, 14)}", r.choice(["a", "b", None]), r.choice(titles)) for i in range(230)]
    df = spark.createDataFrame(rows, "name string, published string, last_seen string, title string").repartition(4)
    order = [*listing.by_recency(df), F.col("name")]
    whole = [r["name"] for r in df.orderBy(*order).collect()]
    index = listing.indexed_pages(df, order, ranges=5)
    assert index.total == 230 and len(index.starts) > 1
    for first in range(0, 230, 20):
        assert [r["name"] for r in index.rows(first, 20).collect()] == whole[first : first + 20]
    assert index.rows(230, 20).count() == 0
    monkeypatch.setattr(listing, "EARLY_ROWS", 50)
    for page, want in ((1, whole[:20]), (6, whole[100:120]), (99, whole[220:])):
        query = listing.SearchQuery(page=page, page_size=20)
        assert [r["name"] for r in listing.result_page(df, query, order).collect()] == want
    assert listing.indexed_pages(df.limit(0), order).total == 0


def test_whole_texts_go_to_python_in_short_batches(spark):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    try:
        for given, kept in (("10000", "500"), ("0", "500"), ("20", "20")):
            spark.conf.set(setting, given)
            for of in (sanitise_html, html_to_text, sanitise_each, texts_of_each):
                of(F.col("x"))
            assert spark.conf.get(setting) == kept
    finally:
        spark.conf.set(setting, before)


def test_long_texts_go_to_python_few_at_a_time(spark, monkeypatch):
    from ledgerfold.functions import html

    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    rows = spark.range(60, numPartitions=1).select(F.repeat(F.lit("<p>"), 10_000).alias("x"))
    size = F.pandas_udf(lambda xs: xs.map(lambda _: len(xs)), "int")
    monkeypatch.setattr(html, "BATCH_BYTES", 200_000)
    spark.conf.unset(setting)
    try:
        for of in (sanitise_html, html_to_text, sanitise_each, texts_of_each):
            of(F.col("x"))
        assert max(r["n"] for r in rows.select(size("x").alias("n")).collect()) <= 10
        spark.conf.set(setting, "1000b")  # a smaller one that is stated stays
        sanitise_html(F.col("x"))
        assert spark.conf.get(setting) == "1000b"
    finally:
        spark.conf.unset(setting)


def test_markup_of_many_columns_is_read_by_one_python_worker(spark):
    rows = spark.createDataFrame([("<b>a", "<p>b", ["<i>c", None]), (None, None, None)], "x string, y string, z array<string>")
    out = rows.select(sanitise_html(F.col("x")), html_to_text(F.col("y")), html_to_text(F.col("x")), sanitise_each(F.col("z")), texts_of_each(F.col("z")))
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [tuple(r) for r in out.collect()] == [("<b>a</b>", "b", "a", ["<i>c</i>", ""], ["c", ""]), ("", "", "", None, None)]


def test_payloads_of_one_small_file_are_cleaned_on_all_cores(spark):
    from ledgerfold.plans.catalogue_queries import sanitised_payloads

    spark.range(40).withColumnRenamed("id", "c_custkey").coalesce(1).write.parquet(path := f"{tempfile.mkdtemp(prefix='spark-', dir='/tmp')}/customer.parquet")
    out = sanitised_payloads(spark, path.rsplit("/", 1)[0])
    assert out.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and out.count() == 40


@pytest.mark.parametrize("name", ["odd_markup_texts", "readable_texts"])
def test_texts_with_odd_edges_equal_their_sql(spark, tmp_path, name):
    """Texts that are blank or NULL, end in line breaks, or hold other white space and separators at the ends of their lines."""
    import duckdb

    from ledgerfold.plans import page_queries  # noqa: F401
    from ledgerfold.plans.registry import ORACLES, QUERIES

    odd = [chr(c) for c in (0, *range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, 0x180E, 0x2000, 0x200B, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)]
    shapes = ("{0}", "a{0}", "{0}a", "a{0}\nb", "a\n{0}b", "a\n{0}\n\nb", "a {0} b", "a\n\n{0}\n", "&lt;{0}<")
    texts = [None, "", "a", "a\n", "a\n\n\n", "\n\na", "a\n\n\n\nb"] + [shape.format(c) for c in odd for shape in shapes]
    r = random.Random(8)
    texts += ["".join(r.choice([*odd, "\n", " ", "a", "&", "<", ">"]) for _ in range(r.randrange(1, 9))) for _ in range(500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = dict(con.execute(ORACLES[name]).fetchall())
    assert len(want) == len(texts) and {i: (t, want[i], v) for i, v in QUERIES[name](spark, str(tmp_path)).collect() if v != want[i] for t in [texts[i]]} == {}
