"""Queries whose tables grow by micro-batches or runs; each final table is held against SQL over all rows at once.

The rows of a given table are first written to a new folder of ``spark.checkpoint.dir``, in files that the stream takes one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.operators import changes, ledger
from ledgerfold.plans.ledger_queries import LEDGER, SPEC, ledger_view, raw_events
from ledgerfold.plans.registry import query, table
from ledgerfold.plans.state_queries import scratch
from ledgerfold.sources.keyed import KeyedTable, named_once, publish

#: Buckets of the tables of these queries; a ledger of any size has more.
FEW = 4
#: Rows of the smallest part for each file that a part is written in.
FILE_ROWS = 100_000


def arriving(parts: list[DataFrame], file_rows: int = FILE_ROWS) -> DataFrame:
    """A stream of one micro-batch per part, in this order.

    Large parts are written by many tasks. Every part has the same number of files, and rows are dealt round so that none
    is missing; that number makes a batch.
    """
    spark, path = parts[0].sparkSession, scratch(parts[0].sparkSession)
    files = max(1, min(part.count() for part in parts) // file_rows)
    for i, part in enumerate(parts):
        (part.repartition(files) if files > 1 else part.coalesce(1)).write.parquet(f"{path}/part={i}")
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", files).parquet(f"{path}/part=*")


def followed(parts: list[DataFrame], generic_routes: list[str] | None = None) -> str:
    """The store of a stream that follows a ledger: each part is appended and then taken in, one micro-batch per append.

    The stream reads the files of the ledger. A batch folds what was appended until then, so the events of a later part are
    not read by an earlier batch.
    """
    from ledgerfold.streaming.resolve_stream import resolve_continuously

    spark = parts[0].sparkSession
    path, store, checkpoint = scratch(spark), scratch(spark), scratch(spark)
    for i, part in enumerate(parts):
        ledger.append_events(part, path, f"b{i}", FEW)
        stream = ledger.stream_table(spark, path).select("identity_key", "seq")
        resolve_continuously(stream, path, store, checkpoint, SPEC, FEW, generic_routes=generic_routes).awaitTermination()
    return store


@query(
    "moves_of_a_stream",
    LEDGER + """
, s AS (SELECT *, 't' || CAST(floor(value / 50) AS BIGINT) || '~m2' AS token FROM e WHERE system IS NOT NULL),
stored AS (SELECT id, system, arg_max(token, (ts, seq)) AS token FROM s WHERE ts < TIMESTAMP '2024-01-10' GROUP BY id, system),
b AS (SELECT *, row_number() OVER w AS rn, lag(token) OVER w AS prev FROM s WHERE ts >= TIMESTAMP '2024-01-10'
      WINDOW w AS (PARTITION BY id, system ORDER BY ts, seq))
SELECT CAST(seq AS BIGINT) AS seq, b.id AS identity_key, b.token AS source_key FROM b LEFT JOIN stored ON stored.id = b.id AND stored.system = b.system
WHERE b.token IS DISTINCT FROM (CASE WHEN rn = 1 THEN stored.token ELSE prev END)""",
)
def moves_of_a_stream(spark, sf_dir):
    """Observations in three batches along time, on a ledger that holds the time before: only moves are appended."""
    from ledgerfold.streaming.ingest import append_on_change

    path = scratch(spark)
    e = ledger_view(spark, sf_dir).filter(F.col("event_type") == "scraped")
    e = e.withColumn("source_key", changes.stamp(F.col("source_key"), 2))
    at = F.col("observed_at")
    ledger.append_events(e.filter(at < "2024-01-10"), path, "before", FEW)
    rows = e.select("identity_key", "source_system", "source_key", "observed_at", "seq", "source", "source_id", "provenance", "discovered_via")
    cuts = [(at >= "2024-01-10") & (at < "2024-01-15"), (at >= "2024-01-15") & (at < "2024-01-20"), at >= "2024-01-20"]
    append_on_change(arriving([rows.filter(c) for c in cuts]), path, scratch(spark), SPEC, FEW).awaitTermination()
    return ledger.read_table(spark, path).filter(F.col("ingest") != "before").select("seq", "identity_key", "source_key")


@query(
    "queue_of_a_stream",
    LEDGER + """
SELECT 'k' || k AS cache_key, arg_min('u' || user_id, seq) AS url, arg_max(kind, seq) AS reason, min(obs) AS queued_at, CAST(min(seq) AS BIGINT) AS queue_pos FROM e GROUP BY k""",
)
def queue_of_a_stream(spark, sf_dir):
    """Cache misses in three batches: the first sighting of a key stays, its newest reason counts."""
    from ledgerfold.streaming.ingest import keep_queue, queue_table

    e, path = raw_events(spark, sf_dir), scratch(spark)
    rows = e.select("seq", F.concat(F.lit("u"), "user_id").alias("url"), F.concat(F.lit("k"), "k").alias("cache_key"),
                    F.col("kind").alias("reason"), F.col("observed_at").alias("queued_at"))
    keep_queue(arriving([rows.filter(F.col("seq") % 3 == i) for i in (2, 0, 1)]), path, scratch(spark), FEW).awaitTermination()
    return queue_table(rows, path, FEW).read().select("cache_key", "url", "reason", "queued_at", "queue_pos")


@query(
    "records_of_a_stream",
    LEDGER + """
SELECT id AS identity_key, CAST(count(*) AS BIGINT) AS event_count, min(obs) FILTER (system IS NOT NULL OR kind = 'error') AS first_seen,
       max(obs) FILTER (system IS NOT NULL OR kind = 'error') AS last_seen,
       arg_max('t' || CAST(floor(value / 50) AS BIGINT), (ts, seq)) FILTER (system IS NOT NULL) AS source_key FROM e GROUP BY id""",
)
def records_of_a_stream(spark, sf_dir):
    """Events that arrive out of their order: a late one takes its place in the fold."""
    from ledgerfold.streaming.resolve_stream import resolved_now

    events = ledger_view(spark, sf_dir)
    store = followed([events.filter(F.col("seq") % 3 == i) for i in (2, 0, 1)])
    return resolved_now(spark, store, FEW).select("identity_key", "event_count", "first_seen", "last_seen", "source_key")


CITING = LEDGER + """
, st AS (SELECT id, kind, 'user|' || arg_max(k, (ts, seq)) AS other FROM e WHERE system IS NOT NULL GROUP BY id, kind),
edge AS (SELECT CASE WHEN kind = 'view' THEN other ELSE id END AS src, CASE WHEN kind = 'view' THEN id ELSE other END AS dst
         FROM st WHERE other <> id AND other IN (SELECT id FROM e)),
c AS (SELECT src AS id, list_sort(list(DISTINCT dst))[1:3] AS l FROM edge GROUP BY src),
b AS (SELECT dst AS id, list_sort(list(DISTINCT src))[1:3] AS l FROM edge GROUP BY dst)
"""


@query(
    "scope_of_a_stream",
    CITING + """
SELECT u.id AS identity_key, CASE WHEN c.l IS NOT NULL THEN 'cites' WHEN b.l IS NOT NULL THEN 'cited-by' ELSE 'unassessed' END AS inclusion_basis,
       array_to_string(coalesce(c.l, b.l, []), ' ') AS names FROM (SELECT DISTINCT id FROM e) u LEFT JOIN c ON c.id = u.id LEFT JOIN b ON b.id = u.id""",
)
def scope_of_a_stream(spark, sf_dir):
    """The citation graph over two batches. A system's later scrape takes back what it stated before."""
    from ledgerfold.streaming.resolve_stream import CitationGraph

    e = raw_events(spark, sf_dir)
    relation = F.when(F.col("kind") == "view", "IsCitedBy").otherwise("Cites")
    stated = F.concat(F.lit('{"related_identifiers":[{"relation":"'), relation, F.lit('","identifier":"user|'), "k", F.lit('"}]}'))
    scraped = F.col("event_type") == "scraped"
    events = e.withColumns({"source": F.when(scraped, stated).otherwise("{}"), "local": F.lit("{}")})
    at = F.col("ts")  # a column of the table, so a part makes no rows of the other
    store = followed([ledger.event_frame(events.filter(cut)) for cut in (at < "2024-01-15", at >= "2024-01-15")], generic_routes=[])
    names = F.array_join(F.regexp_extract_all("inclusion_evidence", F.lit(r"(user\|\d+)"), 1), " ")
    scope = CitationGraph(spark, f"{store}/graph", [], buckets=FEW).scope.read()
    return scope.select("identity_key", "inclusion_basis", names.alias("names"))


# -- runs that follow each other ---------------------------------------------------------------------------


@query(
    "publication_by_bucket",
    """SELECT 'part-' || p_partkey AS name, CASE WHEN p_partkey % 7 = 0 THEN 'pruned' WHEN p_partkey % 10 = 0 OR p_partkey % 11 = 0 THEN 'written' ELSE 'unchanged' END AS action
    FROM part WHERE p_partkey % 7 > 0 OR p_partkey % 10 > 0""",
)
def publication_by_bucket(spark, sf_dir):
    """A second publication: records that are new, changed, as before, or gone."""
    records = KeyedTable(spark, scratch(spark), "name", FEW)
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("part-"), k).alias("name"), "p_name")
    first = rows.filter(k % 10 > 0)
    then = rows.filter(k % 7 > 0).withColumn("p_name", F.when(k % 11 == 0, "another").otherwise(F.col("p_name")))
    for published in (first, then):
        actions = publish(records, published.select("name", "p_name", F.sha2("p_name", 256).alias("digest")))
    return actions


@query(
    "names_over_runs",
    """WITH i AS (SELECT page_id, 'page|' || regexp_replace(regexp_replace(url, '^https?://(www\\.|m\\.|blog\\.)?', ''), '[?#].*$', '') AS id FROM pages),
    f AS (SELECT id, min(page_id) AS first, max(page_id % 3 = 0) AS early, rtrim(regexp_replace(regexp_replace(lower(id), '[^a-z0-9_-]+', '-', 'g'), '-{2,}', '-', 'g'), '-_') AS plain FROM i GROUP BY id),
    g AS (SELECT id, min(page_id) FILTER (page_id % 3 = 0) AS first_early FROM i GROUP BY id),
    r AS (SELECT f.*, row_number() OVER (PARTITION BY plain ORDER BY CASE WHEN early THEN 0 ELSE 1 END, CASE WHEN early THEN first_early ELSE -first END, id) AS rn FROM f JOIN g USING (id))
    SELECT id AS identity_key, CASE WHEN rn = 1 THEN plain ELSE plain || '-' || substr(sha256(id), 1, 8) END AS slug FROM r""",
)
def names_over_runs(spark, sf_dir):
    """Two runs: the second sees all pages and earlier dates, and moves no name of the first. Then the same run again."""
    names = KeyedTable(spark, scratch(spark), "identity_key", FEW)
    bare = F.regexp_replace(F.regexp_replace("url", r"^https?://(www\.|m\.|blog\.)?", ""), r"[?#].*$", "")
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("page|"), bare).alias("identity_key"))
    early = pages.filter(F.col("page_id") % 3 == 0).groupBy("identity_key").agg(F.min("page_id").alias("first_seq"))
    later = pages.groupBy("identity_key").agg((-F.min("page_id")).alias("first_seq"))
    for run in (early, later, later):
        out = named_once(names, run)
    return out.select("identity_key", "slug")
