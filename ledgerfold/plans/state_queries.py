"""Queries of the operators around files, registers, notices and merges, each beside its SQL.

Those that read files first write them from the given tables, to a new folder of ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerfold.functions import text as tx
from ledgerfold.functions.jsonval import get_text, quote
from ledgerfold.operators import curation, intake, ledger, listing, packages, quality, reconcile, reports
from ledgerfold.plans.catalogue_queries import LINKS, _checked
from ledgerfold.plans.ledger_queries import LEDGER, raw_events
from ledgerfold.plans.registry import query, table
from ledgerfold.session import checkpoint_folder
from ledgerfold.sources import registers
from ledgerfold.sources.observation import LISTINGS, read_listing


def scratch(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}"


def json_files(rows: DataFrame, key: str, value: Column) -> str:
    """One text file per row of a small table."""
    path = scratch(rows.sparkSession)
    rows.select(F.col(key).alias("file"), value.alias("value")).write.partitionBy("file").text(path)
    return path


# -- the ledger and its files ------------------------------------------------------


@query(
    "appended_events",
    LEDGER + """SELECT id AS identity_key, CAST(seq AS BIGINT) AS seq, obs AS observed_at,
      CASE WHEN system IS NOT NULL THEN 'scraped' WHEN kind = 'signup' THEN 'annotated' ELSE 'withdrawn' END AS event_type FROM e""",
)
def appended_events(spark, sf_dir):
    """Two appends, one of them twice: an append replaces itself and nothing else."""
    path, events = scratch(spark), ledger.event_frame(raw_events(spark, sf_dir))
    even = F.col("seq") % 2 == 0
    for name, part in (("even", even), ("odd", ~even), ("even", even)):
        ledger.append_events(events.filter(part), path, name, buckets=4)
    return ledger.read_table(spark, path).select("identity_key", "seq", "observed_at", "event_type")


@query(
    "listing_payloads",
    """SELECT CAST(o_orderkey AS VARCHAR) AS source_id, '{"id":"' || o_orderkey || '","status":"' || o_orderstatus || '"}' AS payload
    FROM orders""",
)
def listing_payloads(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    item = F.concat(F.lit('{"id":"'), "o_orderkey", F.lit('","status":"'), "o_orderstatus", F.lit('"}'))
    pages = o.groupBy(F.floor(F.col("o_orderkey") / 4000).alias("page")).agg(F.collect_list(item).alias("items"))
    body = F.concat(F.lit('{"data":['), F.array_join("items", ","), F.lit(',7],"meta":1}'))
    return read_listing(spark, json_files(pages, "page", body), *LISTINGS["datacite"])


@query(
    "record_files",
    """SELECT CASE WHEN n_nationkey % 5 > 1 THEN n_name END AS name,
      CASE n_nationkey % 5 WHEN 0 THEN 'invalid JSON' WHEN 1 THEN 'top level must be an object' END AS message FROM nation""",
)
def record_files(spark, sf_dir):
    k = F.col("n_nationkey") % 5
    body = F.when(k == 0, F.concat(F.lit('{"name":'), "n_name")).when(k == 1, F.concat(F.lit("["), "n_nationkey", F.lit("]")))
    body = F.coalesce(body, F.concat(F.lit('{"name":'), quote(F.col("n_name")), F.lit("}")))
    records, bad = packages.read_records(spark, json_files(table(spark, sf_dir, "nation"), "n_nationkey", body))
    none = F.lit(None).cast("string")
    return records.select(get_text(F.col("doc"), "$.name").alias("name"), none.alias("message")).unionByName(
        bad.select(none.alias("name"), "message"))


@query("run_state", "SELECT o_orderstatus AS source, CAST(count(*) AS BIGINT) AS seen FROM orders GROUP BY ALL")
def run_state(spark, sf_dir):
    path = scratch(spark)
    seen = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("source")).agg(F.count("*").alias("seen"))
    reports.write_state(seen, path)
    missing = reports.read_state(spark, path + "-none", "source string, seen bigint")
    return reports.read_state(spark, path, "source string, seen bigint").unionByName(missing)


@query(
    "register_labels",
    """SELECT CAST(c_custkey AS BIGINT) AS k, CASE WHEN c_nationkey % 4 > 0 THEN n_name ELSE 'org-' || c_nationkey END AS shown
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def register_labels(spark, sf_dir):
    """A register written as JSON lines and read back, then used for labels."""
    path = scratch(spark)
    n = table(spark, sf_dir, "nation").filter("n_nationkey % 4 > 0")
    rows = n.select(
        F.col("n_nationkey").cast("int").alias("pos"), F.concat(F.lit("org-"), "n_nationkey").alias("name"),
        F.col("n_name").alias("title"), F.array("n_name").alias("aliases"))
    rows.write.json(path)
    register = registers.read_register(spark, path, registers.ORGANISATIONS_DDL)
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.concat(F.lit("org-"), "c_nationkey").alias("org"))
    return registers.labelled(c, "org", register, "shown").select("k", "shown")


ANNOTATED = """
WITH f AS (SELECT n_nationkey AS k, 'user|' || n_nationkey AS id FROM nation)
SELECT id AS identity_key, NULL AS message, true AS accepted FROM f WHERE k % 6 = 5
UNION ALL SELECT NULL, CASE k % 6 WHEN 0 THEN 'top level must be a mapping' WHEN 1 THEN '''identity_key'' is required'
  WHEN 2 THEN 'annotations[0]: annotations may not set citation' END, false FROM f WHERE k % 6 < 3
UNION ALL SELECT id, CASE k % 6 WHEN 3 THEN 'owner_org org-none is not registered' ELSE 'task task-none is not registered' END, false
FROM f WHERE k % 6 IN (3, 4)
"""


@query("annotation_files", ANNOTATED)
def annotation_files(spark, sf_dir):
    """Annotation documents as files: read, checked against the registers, rejects beside them."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey") % 6
    who = F.when(k == 1, '""').otherwise(F.concat(F.lit('"user|'), "n_nationkey", F.lit('"')))
    local = (
        F.when(k == 2, '{"citation":"x"}').when(k == 3, '{"owner_org":"org-none"}').when(k == 4, '{"task":["task-none"]}')
        .otherwise('{"owner_org":"org-1","task":["Task 1"]}')
    )
    doc = F.concat(F.lit('{"identity_key":'), who, F.lit(',"annotations":[{"local":'), local, F.lit("}]}"))
    path = json_files(n, "n_nationkey", F.when(k == 0, "[1]").otherwise(doc))
    given, rejects = curation.read_annotations(spark, path)
    orgs = table(spark, sf_dir, "region").select(F.concat(F.lit("org-"), "r_regionkey").alias("name"))
    groups = table(spark, sf_dir, "region").select(
        F.concat(F.lit("task-"), "r_regionkey").alias("name"), F.array().cast("array<string>").alias("aliases"))
    accepted, refused = curation.check_annotations(given, orgs, groups)
    none = F.lit(None).cast("string")
    bare = lambda c: F.regexp_replace(c, r"^[^:]*: ", "")
    return (
        accepted.select("identity_key", none.alias("message"), F.lit(True).alias("accepted"))
        .unionByName(rejects.select(none.alias("identity_key"), bare("message").alias("message"), F.lit(False).alias("accepted")))
        .unionByName(refused.select("identity_key", bare("message").alias("message"), F.lit(False).alias("accepted")))
    )


@query(
    "curator_entries",
    """SELECT CAST(c_custkey AS BIGINT) AS k, CASE WHEN c_custkey % 2 = 0 THEN 'notes,title' ELSE 'notes' END AS fields, 'curator' AS method FROM customer""",
)
def curator_entries(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    local = F.concat(
        F.lit('{"notes":'), quote(F.col("c_name")), F.when(F.col("c_custkey") % 2 == 0, F.lit(',"title":"t"')).otherwise(""), F.lit("}"))
    rows = c.select(F.col("c_custkey").alias("k"), curation.curator_provenance(local).alias("p"))
    return rows.select(
        "k", F.array_join(F.array_sort(F.map_keys("p")), ",").alias("fields"), F.col("p")["notes"]["extraction_method"].alias("method"))


# -- intake and names --------------------------------------------------------------


@query(
    "held_identities",
    """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'own|' || o_orderkey
      WHEN o_custkey % 3 = 0 THEN 'held|' || o_custkey END AS identity FROM orders""",
)
def held_identities(spark, sf_dir):
    """Payloads fetched for a backfill stay under the identity that asked, unless they name one."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("source_id"),
        F.when(k % 11 == 0, F.concat(F.lit("own|"), k)).alias("identity_override"))
    asked = table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select(
        F.col("c_custkey").cast("string").alias("source_id"), F.concat(F.lit("held|"), "c_custkey").alias("identity_key"))
    return intake.under_held_identity(rows, asked).select("o_orderkey", F.col("identity_override").alias("identity"))


@query(
    "misnamed_files",
    """SELECT p_name AS record, 'name' AS field, 'does not match filename stem file-' || p_partkey AS message FROM part WHERE p_partkey % 7 = 0""",
)
def misnamed_files(spark, sf_dir):
    stem = F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("file-"), "p_partkey")).otherwise(F.col("p_name"))
    return quality.misnamed_files(table(spark, sf_dir, "part").withColumn("stem", stem), "p_name", "stem")


@query(
    "orcids",
    """WITH d AS (SELECT c_custkey, lpad(c_custkey::VARCHAR, 16, '0') AS x FROM customer)
    SELECT CAST(c_custkey AS BIGINT) AS k, CASE WHEN c_custkey % 4 = 3 THEN 'no orcid'
      ELSE substr(x, 1, 4) || '-' || substr(x, 5, 4) || '-' || substr(x, 9, 4) || '-' || substr(x, 13, 4) END AS orcid FROM d""",
)
def orcids(spark, sf_dir):
    k = F.col("c_custkey")
    x = F.lpad(k.cast("string"), 16, "0")
    dashed = F.regexp_replace(x, r"(.{4})(?=.)", "$1-")
    said = (
        F.when(k % 4 == 0, F.concat(F.lit("https://orcid.org/"), x)).when(k % 4 == 1, F.concat(F.lit(" ORCID.org/"), dashed))
        .when(k % 4 == 2, dashed).otherwise("no orcid")
    )
    return table(spark, sf_dir, "customer").select(k.alias("k"), tx.orcid_dashed(tx.orcid(said)).alias("orcid"))


@query(
    "first_authors",
    """SELECT CAST(s_suppkey AS BIGINT) AS k, CASE s_suppkey % 3 WHEN 0 THEN 'muller' WHEN 1 THEN 'sorensen' ELSE '' END AS author FROM supplier""",
)
def first_authors(spark, sf_dir):
    k = F.col("s_suppkey") % 3
    people = F.when(k == 0, '[{"name":""},{"name":"Müller, Ann"},{"name":"Zed"}]').when(k == 1, '["Bo Sørensen"]').otherwise("[]")
    effective = F.create_map(F.lit("authors"), people)
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), reconcile.first_author(effective).alias("author"))


@query(
    "recency_order",
    """SELECT CAST(p_partkey AS BIGINT) AS k, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_partkey % 5 > 0 THEN 2000 + p_size END
      DESC NULLS LAST, p_size % 4 DESC, p_name, p_partkey) AS INTEGER) AS place FROM part""",
)
def recency_order(spark, sf_dir):
    """Newest first; titles in the order of the locale, which for these plain words is that of their letters."""
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(
        k.alias("k"), "p_brand", F.when(k % 5 > 0, (F.lit(2000) + F.col("p_size")).cast("string")).alias("published"),
        (F.col("p_size") % 4).cast("string").alias("last_seen"), F.col("p_name").alias("title"))
    place = F.row_number().over(W.partitionBy("p_brand").orderBy(*listing.by_recency(rows), "k"))
    return rows.select("k", place.alias("place"))


# -- merges and notices ------------------------------------------------------------


def _merge_candidates(spark, sf_dir):
    k = F.col("l_suppkey") % 3
    kind = F.when(k == 0, "shared-doi").when(k == 1, "declared").otherwise("preprint-pair")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s|"), "l_suppkey").alias("primary"), F.concat(F.lit("o|"), "l_orderkey").alias("secondary"), kind.alias("kind")
    ).distinct()


CANDIDATES = """
WITH c AS (SELECT DISTINCT 's|' || l_suppkey AS p, 'o|' || l_orderkey AS s, l_suppkey, l_orderkey,
  CASE l_suppkey % 3 WHEN 0 THEN 'shared-doi' WHEN 1 THEN 'declared' ELSE 'preprint-pair' END AS kind FROM lineitem)
"""


@query(
    "candidate_order",
    CANDIDATES + """SELECT p AS primary, s AS secondary, CAST(row_number() OVER (PARTITION BY s ORDER BY kind, p, s) AS INTEGER) AS n FROM c""",
)
def candidate_order(spark, sf_dir):
    placed = reconcile.order_candidates(_merge_candidates(spark, sf_dir))
    n = F.row_number().over(W.partitionBy("secondary").orderBy("place"))
    return placed.select("primary", "secondary", n.alias("n"))


@query("standing_merges", CANDIDATES + "SELECT p AS primary, s AS secondary FROM c WHERE l_orderkey % 2 = 0 AND l_suppkey % 4 = 1")
def standing_merges(spark, sf_dir):
    """A merge stands where the record is suppressed into that very primary."""
    cands = _merge_candidates(spark, sf_dir)
    s, p = F.regexp_extract("secondary", r"(\d+)", 1).cast("long"), F.regexp_extract("primary", r"(\d+)", 1).cast("long")
    held = cands.filter(p % 4 == 1).select(
        F.col("secondary").alias("identity_key"),
        F.create_map(F.lit("suppressed"), F.when(s % 2 == 0, "true").otherwise("false"), F.lit("merged_into"), quote(F.col("primary"))).alias("local"))
    return reconcile.already_merged(cands, held).select("primary", "secondary").distinct()


@query(
    "fresh_notices",
    """SELECT 'o|' || o_orderkey AS identity_key, 'merge_proposal' AS event_type, '{"other":"c|' || o_custkey || '"}' AS notice, 'reconcile' AS actor
    FROM orders WHERE o_orderkey % 3 > 0""",
)
def fresh_notices(spark, sf_dir):
    """Notices as events, but for those that an event states already."""
    o = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("o|"), "o_orderkey").alias("identity_key"), F.lit("merge_proposal").alias("event_type"),
        F.concat(F.lit('{"other":"c|'), "o_custkey", F.lit('"}')).alias("notice"), F.lit("2024-01-01T00:00:00Z").alias("observed_at"),
        F.lit("n").alias("note"), (F.col("o_orderkey") % 3 == 0).alias("known"))
    standing = ledger.notice_events(o.filter("known").drop("known"))
    fresh = reconcile.new_notices(o.drop("known"), standing)
    return ledger.notice_events(fresh).select("identity_key", "event_type", "notice", "actor")


@query(
    "link_notices",
    LINKS + """
, r AS (SELECT c_custkey AS name, c_custkey % (SELECT count(*) FROM pages) AS page_id FROM customer),
h AS (SELECT host FROM c WHERE NOT skipped GROUP BY host HAVING NOT bool_or(ok))
SELECT DISTINCT 'dead_link' AS type, CAST(r.name AS VARCHAR) AS record, c.url, NULL AS host FROM r JOIN c USING (page_id) WHERE NOT ok AND NOT skipped
UNION ALL SELECT 'source_unreachable', NULL, NULL, host FROM h
UNION ALL SELECT 'run', CAST(page_id AS VARCHAR), url, NULL FROM c WHERE skipped""",
)
def link_notices(spark, sf_dir):
    """Notices of the link check and of another stage in one table."""
    one = table(spark, sf_dir, "pages").agg(F.count("*").alias("n"))
    c = table(spark, sf_dir, "customer").crossJoin(F.broadcast(one))  # one row
    shown = c.select(F.col("c_custkey").cast("string").alias("name"), (F.col("c_custkey") % F.col("n")).alias("page_id"))
    checked = _checked(spark, sf_dir)
    urls = shown.join(table(spark, sf_dir, "pages").select("page_id", "url"), "page_id").select("name", "url", "page_id")
    by_record = reports.dead_by_record(urls, reports.dead_links(checked), check="page_id")
    found = reports.link_notices(by_record, checked, reports.unreachable_hosts(checked), check="page_id")
    other = checked.filter("skipped").select(F.lit("run").alias("type"), F.col("page_id").cast("string").alias("record"), "url")
    return reports.union_notices([found, other]).select("type", "record", "url", "host").distinct()


@query(
    "silent_sources",
    """SELECT n_name AS source FROM nation WHERE n_nationkey % 2 = 0 AND n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_nationkey % 3 > 0)""",
)
def silent_sources(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    sources = n.select(F.col("n_name").alias("name"), (F.col("n_nationkey") % 2 == 0).alias("enabled"))
    reached = table(spark, sf_dir, "customer").filter("c_nationkey % 3 > 0").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("source"))
    return reports.unreachable_sources(sources, reached)
