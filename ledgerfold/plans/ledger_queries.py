"""Ledger queries: the ``events`` table read as an event ledger.

A user is an identity. Clicks, views and purchases are scrapes by the system of
that name, a sign-up is an annotation and an error a withdrawal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.functions.jsonval import quote, text_of
from ledgerfold.operators import changes, curation, graph, ledger, listing, reconcile, reports
from ledgerfold.operators import resolve as rs
from ledgerfold.plans.registry import query, spread, table
from ledgerfold.spec import PROVENANCE_TYPE, LedgerSpec

SPEC = LedgerSpec(precedence={"click": 10, "view": 20, "purchase": 30})
SCRAPE_TYPES = ("click", "view", "purchase")

# The same reading of ``events`` in SQL; every oracle starts from it.
LEDGER = """
WITH e AS (
  SELECT event_id AS seq, 'user|' || user_id AS id, user_id, ts, event_type AS kind, value,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS obs,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE WHEN event_type IN ('click', 'view', 'purchase') THEN event_type END AS system,
         CASE event_type WHEN 'click' THEN 10 WHEN 'view' THEN 20 WHEN 'purchase' THEN 30 END AS rnk
  FROM events)
"""


def stamped(ts: str = "ts") -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        stamped().alias("observed_at"),
        F.concat(F.lit("user|"), F.col("user_id")).alias("identity_key"),
        F.when(kind.isin(*SCRAPE_TYPES), kind).alias("source_system"),
        F.when(kind.isin(*SCRAPE_TYPES), "scraped").when(kind == "signup", "annotated")
        .otherwise("withdrawn").alias("event_type"),
        kind.alias("kind"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        "user_id", "ts", "value",
    )


def payload(value: Column, k: Column) -> Column:
    """``{extra, keywords, value}`` as JSON; small values are stated as null."""
    shown = F.when(value < 20, "null").otherwise(value.cast("string"))
    return F.concat(
        F.lit('{"extra":{"x'), (k % 5).cast("string"), F.lit('":'), shown,
        F.lit('},"keywords":["k'), (k % 20).cast("string"), F.lit('"],"value":'), shown, F.lit("}"),
    )


def ledger_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_events(spark, sf_dir)
    body = payload(F.col("value"), F.col("k"))
    is_scrape = F.col("event_type") == "scraped"
    entry = F.concat(
        F.lit('{"f'), (F.col("k") % 4).cast("string"), F.lit('":{"extraction_method":"api"'),
        F.when(F.col("k") % 7 == 0, F.lit(',"source_system":"view"')).otherwise(F.lit("")), F.lit("}}"),
    )
    return ledger.event_frame(
        rows.withColumns(
            {
                "source": F.when(is_scrape, body).otherwise("{}"),
                "local": F.when(F.col("event_type") == "annotated", body).otherwise("{}"),
                "source_key": F.when(is_scrape, F.concat(F.lit("t"), F.floor(F.col("value") / 50).cast("string"))),
                "source_id": F.when(is_scrape, F.col("user_id").cast("string")),
                "provenance": F.when(is_scrape, F.from_json(entry, PROVENANCE_TYPE)).otherwise(
                    F.create_map().cast(PROVENANCE_TYPE)),
                "discovered_via": F.when(
                    is_scrape, F.array(F.concat(F.lit("route:"), (F.col("k") % 5).cast("string")))
                ).otherwise(F.array().cast("array<string>")),
            }
        )
    )


@query(
    "latest_per_source",
    LEDGER + """
SELECT id AS identity_key, system, CAST(arg_max(seq, (ts, seq)) AS BIGINT) AS seq,
       arg_max(obs, (ts, seq)) AS observed_at, arg_max('t' || CAST(floor(value / 50) AS BIGINT), (ts, seq)) AS source_key
FROM e WHERE system IS NOT NULL GROUP BY id, system""",
)
def latest_per_source(spark, sf_dir):
    state = rs.system_state(ledger_view(spark, sf_dir), SPEC)
    return rs.latest_scrapes(state).select("identity_key", "system", "seq", "observed_at", "source_key")


FOLD = LEDGER + """
, last AS (
  SELECT id, system, any_value(rnk) AS rnk, arg_max(CASE WHEN value < 20 THEN 'null' ELSE CAST(value AS VARCHAR) END, (ts, seq)) AS v,
         arg_max(k, (ts, seq)) AS k, max((ts, seq)) AS o
  FROM e WHERE system IS NOT NULL GROUP BY id, system),
src AS (SELECT id, arg_min(v, rnk) FILTER (v <> 'null') AS v FROM last GROUP BY id),
loc AS (SELECT id, arg_max(CASE WHEN value < 20 THEN 'null' ELSE CAST(value AS VARCHAR) END, (ts, seq)) AS v
        FROM e WHERE kind = 'signup' GROUP BY id)
"""


@query(
    "resolve_scalar",
    FOLD + """
SELECT coalesce(src.id, loc.id) AS identity_key, CAST(coalesce(src.v, nullif(loc.v, 'null')) AS DOUBLE) AS value
FROM src FULL JOIN loc ON src.id = loc.id""",
)
def resolve_scalar(spark, sf_dir):
    events = ledger_view(spark, sf_dir)
    fields = rs.source_fields(rs.system_state(events, SPEC), SPEC)
    local = rs.local_state(rs.local_fields(events), SPEC)
    eff = rs.effective_fields(rs.compose_scalars(fields, SPEC), local)
    return eff.filter(F.col("field") == "value").select(
        "identity_key", F.col("effective_value").cast("double").alias("value")
    )


@query(
    "bag_merge",
    FOLD + """
SELECT id AS identity_key, 'x' || (k % 5) AS key, CAST(arg_min(v, rnk) AS DOUBLE) AS value
FROM last WHERE v <> 'null' GROUP BY id, k % 5""",
)
def bag_merge(spark, sf_dir):
    fields = rs.source_fields(rs.system_state(ledger_view(spark, sf_dir), SPEC), SPEC)
    bags = rs.compose_bags(fields, SPEC)
    return bags.select("identity_key", F.explode(F.from_json("value", "map<string,double>")).alias("key", "value"))


@query(
    "resolve_sets",
    FOLD + """
, t AS (
  SELECT id, 'k' || (k % 20) AS token, 0 AS ns, -rnk AS r, 0 AS seq, TIMESTAMP '1970-01-01' AS ts FROM last
  UNION ALL SELECT id, 'k' || (k % 20), 1, 0, seq, ts FROM e WHERE kind = 'signup'),
u AS (SELECT id, token, min((ns, r, ts, seq)) AS place FROM t GROUP BY id, token)
SELECT id AS identity_key, token, CAST(row_number() OVER (PARTITION BY id ORDER BY place) AS BIGINT) AS position FROM u""",
)
def resolve_sets(spark, sf_dir):
    events = ledger_view(spark, sf_dir)
    fields = rs.source_fields(rs.system_state(events, SPEC), SPEC)
    tokens = rs.set_tokens(fields, rs.local_fields(events), SPEC).filter(F.col("field") == "keywords")
    # The members of one record's set, as the record lists them.
    lists = tokens.groupBy("identity_key").agg(F.array_sort(F.collect_list(F.struct("place", "token"))).alias("m"))
    return lists.select("identity_key", F.posexplode("m").alias("p", "x")).select(
        "identity_key", text_of(F.col("x.token")).alias("token"), (F.col("p") + 1).cast("bigint").alias("position")
    )


@query(
    "discovery_routes",
    LEDGER + """
SELECT id AS identity_key, 'route:' || (k % 5) AS route, arg_min(obs, (ts, seq)) AS first_at, CAST(arg_min(seq, (ts, seq)) AS BIGINT) AS first_seq
FROM e WHERE system IS NOT NULL GROUP BY id, k % 5""",
)
def discovery_routes(spark, sf_dir):
    routes = rs.discovery_routes(ledger_view(spark, sf_dir))
    return routes.select(
        "identity_key", "route", F.col("place.observed_at").alias("first_at"), F.col("place.seq").alias("first_seq")
    )


@query(
    "identity_facts",
    LEDGER + """
SELECT id AS identity_key, min(obs) FILTER (kind <> 'signup') AS first_seen, max(obs) FILTER (kind <> 'signup') AS last_seen,
       CAST(count(*) AS BIGINT) AS event_count,
       array_to_string(list_sort(list(DISTINCT system) FILTER (system IS NOT NULL)), ',') AS systems,
       arg_max(system, (ts, seq)) FILTER (system IS NOT NULL) AS source_system
FROM e GROUP BY id""",
)
def identity_facts(spark, sf_dir):
    facts = rs.identity_facts(rs.system_state(ledger_view(spark, sf_dir), SPEC))
    return facts.select(
        "identity_key", "first_seen", "last_seen", "event_count",
        F.array_join("source_systems", ",").alias("systems"), "source_system",
    )


@query(
    "standing_withdrawals",
    LEDGER + """
, a AS (SELECT id, CASE WHEN k % 3 = 0 THEN '' ELSE 's' || (k % 3) END AS system, kind = 'error' AS flag, obs, ts, seq
        FROM e WHERE kind = 'error' OR (kind = 'purchase' AND k % 3 > 0)),
l AS (SELECT id, system, arg_max(flag, (ts, seq)) AS flag, arg_max(obs, (ts, seq)) AS obs FROM a GROUP BY id, system)
SELECT id AS identity_key, min(obs) AS withdrawn_at FROM l WHERE flag GROUP BY id""",
)
def standing_withdrawals(spark, sf_dir):
    rows = raw_events(spark, sf_dir).filter(
        F.col("kind").isin("error") | ((F.col("kind") == "purchase") & (F.col("k") % 3 > 0))
    )
    system = F.when(F.col("k") % 3 > 0, F.concat(F.lit("s"), (F.col("k") % 3).cast("string")))
    claims = ledger.event_frame(
        rows.withColumns({"source_system": system, "source": F.lit('{"withdrawn":false}')})
    )
    facts = rs.identity_facts(rs.system_state(claims, SPEC))
    return facts.filter("withdrawn").select("identity_key", "withdrawn_at")


@query(
    "provenance_fold",
    LEDGER + """
, s AS (SELECT id, 'f' || (k % 4) AS field, system, CASE WHEN k % 7 = 0 THEN 'view' ELSE system END AS stamp, (ts, seq) AS o
        FROM e WHERE system IS NOT NULL),
setter AS (SELECT id, field, arg_max(stamp, o) AS stamp, max(o) AS o FROM s GROUP BY id, field),
scrape AS (SELECT id, system, max(o) AS o FROM s GROUP BY id, system)
SELECT setter.id AS identity_key, field, stamp AS source_system FROM setter
LEFT JOIN scrape ON scrape.id = setter.id AND scrape.system = setter.stamp
WHERE scrape.o IS NULL OR scrape.o <= setter.o""",
)
def provenance_fold(spark, sf_dir):
    events = ledger_view(spark, sf_dir)
    fields = rs.provenance_fields(events, rs.system_state(events, SPEC))
    return fields.select("identity_key", "field", F.col("entry.source_system").alias("source_system"))


@query(
    "displacements",
    FOLD + """
SELECT src.id AS identity_key, 'value' AS field, CAST(loc.v AS DOUBLE) AS displaced, CAST(src.v AS DOUBLE) AS kept
FROM src JOIN loc ON src.id = loc.id WHERE src.v IS NOT NULL AND loc.v <> 'null' AND src.v <> loc.v""",
)
def displacements(spark, sf_dir):
    events = ledger_view(spark, sf_dir)
    fields = rs.source_fields(rs.system_state(events, SPEC), SPEC)
    eff = rs.effective_fields(
        rs.compose_scalars(fields, SPEC), rs.local_state(rs.local_fields(events), SPEC)
    )
    found = rs.notices(events, eff).filter("implicit").filter(F.col("field") == "value")
    return found.select(
        "identity_key", "field",
        F.get_json_object("detail", "$.displaced_local_value").cast("double").alias("displaced"),
        F.get_json_object("detail", "$.source_value").cast("double").alias("kept"),
    )


@query(
    "resolved_records",
    FOLD + """
, f AS (SELECT id, min(obs) FILTER (kind <> 'signup') AS first_seen, max(obs) FILTER (kind <> 'signup') AS last_seen,
               count(*) AS n, count(DISTINCT system) AS systems, max((kind = 'error')::INT) AS gone,
               count(DISTINCT k % 5) FILTER (system IS NOT NULL) AS routes FROM e GROUP BY id),
w AS (SELECT id, count(DISTINCT token) AS n FROM (
        SELECT id, k % 20 AS token FROM last UNION ALL SELECT id, k % 20 FROM e WHERE kind = 'signup') GROUP BY id)
SELECT f.id AS identity_key, first_seen, last_seen, CAST(f.n AS BIGINT) AS event_count, CAST(systems AS INTEGER) AS systems,
       gone = 1 AS withdrawn, CAST(coalesce(src.v, nullif(loc.v, 'null')) AS DOUBLE) AS value,
       CAST(coalesce(w.n, 0) AS INTEGER) AS keywords, CAST(routes AS INTEGER) AS routes
FROM f LEFT JOIN src ON src.id = f.id LEFT JOIN loc ON loc.id = f.id LEFT JOIN w ON w.id = f.id""",
)
def resolved_records(spark, sf_dir):
    resolved = rs.resolve(ledger_view(spark, sf_dir), SPEC)
    words = F.from_json(F.element_at("effective", "keywords"), "array<string>")
    return resolved.select(
        "identity_key", "first_seen", "last_seen", "event_count", F.size("source_systems").alias("systems"),
        "withdrawn", F.element_at("effective", "value").cast("double").alias("value"),
        F.coalesce(F.size(words), F.lit(0)).alias("keywords"), F.size("discovered_via").alias("routes"),
    )


@query(
    "last_events",
    LEDGER + """
SELECT id AS identity_key, CAST(arg_max(seq, (ts, seq)) AS BIGINT) AS seq, max(obs) AS observed_at FROM e
WHERE kind = 'purchase' GROUP BY id""",
)
def last_events(spark, sf_dir):
    rows = ledger.last_event(ledger_view(spark, sf_dir), "scraped", " Purchase")
    return rows.select("identity_key", "seq", "observed_at")


@query(
    "identity_list",
    "SELECT DISTINCT 'user|' || user_id AS identity_key, 'user-' || user_id AS slug FROM events",
)
def identity_list(spark, sf_dir):
    return ledger.identities(ledger_view(spark, sf_dir))


def log_lines(spark, sf_dir) -> DataFrame:
    """One log per user; some lines are cut short, some belong to somebody else."""
    e = spread(raw_events(spark, sf_dir), "seq")
    key = F.when(F.col("k") % 17 == 3, "user|stranger").otherwise(F.col("identity_key"))
    line = F.concat(
        F.lit('{"identity_key":'), quote(key), F.lit(',"observed_at":"'), F.col("observed_at"),
        F.lit('","event_type":"'),
        F.when(F.col("k") % 19 == 5, "guessed").otherwise(F.col("event_type")),
        F.lit('"'), F.when(F.col("k") % 23 == 7, ',"colour":1').otherwise(""), F.lit("}"),
    )
    cut = F.when(F.col("k") % 13 == 1, F.substring(line, 1, 20)).otherwise(line)
    return e.select(
        F.concat(F.lit("/log/user-"), F.col("user_id"), F.lit(".jsonl")).alias("path"),
        F.col("seq").alias("line_no"), cut.alias("line"),
    )


LOG = LEDGER + """
, l AS (SELECT *, CASE WHEN k % 17 = 3 THEN 'user|stranger' ELSE id END AS key, k % 13 = 1 AS cut,
               k % 19 = 5 OR k % 23 = 7 AS odd FROM e),
o AS (SELECT user_id, arg_min(key, seq) AS owner FROM l WHERE NOT cut GROUP BY user_id),
j AS (SELECT l.*, o.owner FROM l LEFT JOIN o USING (user_id))
"""


@query(
    "ledger_problems",
    LOG + """
SELECT 'user-' || user_id || '.jsonl' AS path, CAST(seq AS BIGINT) AS line,
       CASE WHEN cut OR odd THEN 'malformed event line' ELSE 'event belongs to another identity' END AS reason
FROM j WHERE cut OR odd OR key <> owner
UNION ALL
SELECT 'user-' || user_id || '.jsonl', 1, 'file name does not match its identity' FROM o WHERE owner = 'user|stranger'""",
)
def ledger_problems(spark, sf_dir):
    _, problems = ledger.parse_events(log_lines(spark, sf_dir))
    return problems.select("path", "line", "reason")


@query(
    "ledger_read",
    LOG + """
SELECT key AS identity_key, CAST(seq AS BIGINT) AS seq, obs AS observed_at FROM j WHERE NOT cut AND NOT odd AND key = owner""",
)
def ledger_read(spark, sf_dir):
    events, _ = ledger.parse_events(log_lines(spark, sf_dir))
    return events.select("identity_key", "seq", "observed_at")


@query(
    "event_rules",
    LEDGER + """
SELECT CAST(seq AS BIGINT) AS seq, message FROM (
  SELECT seq, unnest(list_filter([
    CASE WHEN k % 5 = 0 THEN 'unknown extraction method' END,
    CASE WHEN k % 7 = 0 AND k % 5 <> 0 THEN 'model-inferred field without model and prompt version' END,
    CASE WHEN value > 150 THEN 'confidence outside [0, 1]' END], lambda x: x IS NOT NULL)) AS message FROM e)""",
)
def event_rules(spark, sf_dir):
    e = spread(raw_events(spark, sf_dir), "seq")
    method = F.when(F.col("k") % 5 == 0, "guess").when(F.col("k") % 7 == 0, "llm").otherwise("api")
    line = F.concat(
        F.lit('{"identity_key":"a","observed_at":"x","event_type":"scraped","provenance":{"f":{"extraction_method":"'),
        method, F.lit('","confidence":'), (F.col("value") / 150).cast("string"), F.lit("}}}"),
    )
    return e.select("seq", F.explode(ledger.event_messages(line, F.try_parse_json(line))).alias("message"))


@query(
    "changed_rows",
    LEDGER + """
, s AS (SELECT *, 't' || CAST(floor(value / 50) AS BIGINT) || '~m2' AS token FROM e WHERE system IS NOT NULL),
stored AS (SELECT id, system, arg_max(token, (ts, seq)) AS token FROM s WHERE ts < TIMESTAMP '2024-01-10' GROUP BY id, system),
b AS (SELECT *, row_number() OVER w AS rn, lag(token) OVER w AS prev FROM s WHERE ts >= TIMESTAMP '2024-01-10'
      WINDOW w AS (PARTITION BY id, system ORDER BY ts, seq))
SELECT CAST(seq AS BIGINT) AS seq, b.id AS identity_key, b.token AS source_key FROM b LEFT JOIN stored ON stored.id = b.id AND stored.system = b.system
WHERE b.token IS DISTINCT FROM (CASE WHEN rn = 1 THEN stored.token ELSE prev END)""",
)
def changed_rows(spark, sf_dir):
    e = ledger_view(spark, sf_dir).filter(F.col("event_type") == "scraped")
    e = e.withColumn("source_key", changes.stamp(F.col("source_key"), 2))
    old = e.filter(F.col("observed_at") < "2024-01-10")
    new = e.filter(F.col("observed_at") >= "2024-01-10").select(
        "identity_key", "source_system", "source_key", "observed_at", "seq"
    )
    moved = changes.changed_rows(new, changes.last_tokens(old), SPEC)
    return moved.select("seq", "identity_key", "source_key")


@query(
    "payload_tokens",
    """SELECT CAST(event_id AS BIGINT) AS event_id, substr(sha256('{"k":' || json_extract_string(props, '$.k') || ',"type":"' || event_type || '"}'), 1, 16) || '~m1' AS token FROM events""",
)
def payload_tokens(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    raw = F.concat(F.lit('{ "type": "'), "event_type", F.lit('", "k": '), F.get_json_object("props", "$.k"), F.lit(" }"))
    return e.select("event_id", changes.stamp(changes.payload_hash(raw), 1).alias("token"))


@query(
    "backfill_queue",
    LEDGER + """
, s AS (SELECT id, system, CASE WHEN k % 3 > 0 THEN k END AS doi, ts, seq FROM (SELECT * REPLACE (CASE WHEN user_id % 4 = 0 AND system = 'purchase' THEN 'view' ELSE system END AS system) FROM e) WHERE system IS NOT NULL),
g AS (SELECT id, max((system = 'purchase')::INT) AS done, arg_max(doi, (ts, seq)) FILTER (doi IS NOT NULL) AS doi FROM s GROUP BY id)
SELECT id AS identity_key, CAST(doi AS VARCHAR) AS source_id FROM g WHERE done = 0 AND doi IS NOT NULL""",
)
def backfill_queue(spark, sf_dir):
    # a quarter of the users never met the source that would have filled them in
    e = raw_events(spark, sf_dir)
    met = F.when((F.col("user_id") % 4 == 0) & (F.col("source_system") == "purchase"), "view").otherwise(F.col("source_system"))
    e = e.withColumn("source_system", met)
    doi = F.when(F.col("k") % 3 > 0, F.concat(F.lit('"https://doi.org/10.5072/ZENODO.'), F.col("k"), F.lit('"'))).otherwise("null")
    events = ledger.event_frame(e.withColumn("source", F.concat(F.lit('{"doi":'), doi, F.lit("}"))))
    queue = changes.backfill_queue(events, "purchase", r"^10\.5072/zenodo\.(\d+)$")
    return queue.select("identity_key", "source_id")


ROUTELESS = LEDGER + """
, s AS (SELECT id, system, user_id, ts, seq, (k % 10 = 0 AND user_id % 3 > 0)::INT AS routed FROM e WHERE system IS NOT NULL),
p AS (SELECT id, CAST(any_value(user_id) AS VARCHAR) AS source_id FROM s GROUP BY id HAVING max(routed) = 0 AND max((system = 'view')::INT) = 1)
"""


def _routeless(spark, sf_dir):
    e = ledger_view(spark, sf_dir)
    k = raw_events(spark, sf_dir).select("seq", ((F.col("k") % 10 == 0) & (F.col("user_id") % 3 > 0)).alias("routed"))
    kept = F.when(F.col("routed"), F.col("discovered_via")).otherwise(F.array().cast("array<string>"))
    events = e.join(k, "seq").withColumn("discovered_via", kept)
    return changes.routeless(events, "view")


@query("routeless", ROUTELESS + "SELECT id AS identity_key, source_id FROM p")
def routeless(spark, sf_dir):
    return _routeless(spark, sf_dir)


@query(
    "confirmed_routes",
    ROUTELESS + """
, q AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS source_id, 'query:' || (k % 3) AS route, (user_id + k % 3) % 2 = 0 AS hit FROM e)
SELECT p.id AS identity_key, coalesce(string_agg(DISTINCT route, ',' ORDER BY route) FILTER (hit), 'query:no-match') AS routes
FROM p JOIN q USING (source_id) GROUP BY p.id""",
)
def confirmed_routes(spark, sf_dir):
    asked = raw_events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("source_id"), (F.col("k") % 3).alias("pos"),
        F.concat(F.lit("query:"), (F.col("k") % 3).cast("string")).alias("route"),
        ((F.col("user_id") + F.col("k") % 3) % 2 == 0).alias("matched"),
    ).distinct()
    found = changes.confirm_routes(_routeless(spark, sf_dir), asked)
    return found.select("identity_key", F.array_join("discovered_via", ",").alias("routes"))


# -- graph ---------------------------------------------------------------------


def _claims(spark, sf_dir):
    """Users as records that each state one DOI: ``10.5072/u.<user % 40>``."""
    users = raw_events(spark, sf_dir).select("user_id").distinct()
    key = F.when(F.col("user_id") % 4 == 0, F.concat(F.lit("10.5072/u."), F.col("user_id"))).otherwise(
        F.concat(F.lit("User|"), F.col("user_id"))
    )
    doi = F.concat(F.lit('"doi:10.5072/U.'), F.col("user_id") % 40, F.lit('"'))
    return users.select(
        "user_id", key.alias("identity_key"), F.create_map(F.lit("doi"), doi).alias("effective"),
        F.array(F.when(F.col("user_id") % 3 == 0, "click").otherwise("view")).alias("source_systems"),
    )


CLAIMS = """
WITH r AS (SELECT DISTINCT user_id, CASE WHEN user_id % 4 = 0 THEN '10.5072/u.' || user_id ELSE 'User|' || user_id END AS key,
           '10.5072/u.' || (user_id % 40) AS doi FROM events)
"""


@query(
    "alias_index",
    CLAIMS + """
, a AS (SELECT lower(key) AS alias, key, 0 AS p FROM r UNION ALL SELECT doi, key, 1 FROM r)
SELECT alias, coalesce(max(key) FILTER (p = 0), min(key)) AS identity_key FROM a GROUP BY alias""",
)
def alias_index(spark, sf_dir):
    return graph.alias_index_scope(_claims(spark, sf_dir))


@query(
    "alias_index_for_merges",
    CLAIMS + """
, a AS (SELECT key AS alias, key FROM r UNION SELECT lower(key), key FROM r UNION SELECT doi, key FROM r)
SELECT alias, min(key) AS identity_key FROM a GROUP BY alias""",
)
def alias_index_for_merges(spark, sf_dir):
    return graph.alias_index_merge(_claims(spark, sf_dir))


EDGES = LEDGER + """
, st AS (SELECT DISTINCT id, 'user|' || k AS other, kind <> 'view' AS outward FROM e WHERE system IS NOT NULL),
known AS (SELECT DISTINCT id FROM e),
edge AS (SELECT DISTINCT CASE WHEN outward THEN st.id ELSE other END AS src, CASE WHEN outward THEN other ELSE st.id END AS dst
         FROM st JOIN known ON known.id = st.other WHERE st.id <> other)
"""


def _edges(spark, sf_dir):
    """A user cites the user its event names; a view states it the other way round."""
    e = raw_events(spark, sf_dir).filter(F.col("event_type") == "scraped")
    stated = e.select(
        "identity_key", F.concat(F.lit("user|"), F.col("k")).alias("alias"), (F.col("kind") != "view").alias("outward")
    )
    users = raw_events(spark, sf_dir).select(F.col("identity_key").alias("alias"), "identity_key").distinct()
    return graph.citation_edges(stated, users)


@query("citation_edges", EDGES + "SELECT src, dst FROM edge")
def citation_edges(spark, sf_dir):
    return _edges(spark, sf_dir)


SCOPE = EDGES + """
, u AS (SELECT id, list_sort(list(DISTINCT kind) FILTER (system IS NOT NULL AND kind <> 'view' AND k % 30 = 1)) AS routes,
        max((system IS NOT NULL AND (kind = 'view' OR k % 30 = 1))::INT) AS seen,
        max((kind = 'signup' AND k % 40 = 2)::INT) AS tasked, any_value(user_id) AS user_id FROM e GROUP BY id),
c AS (SELECT src AS id, list_sort(list(dst)) AS l FROM edge GROUP BY src),
b AS (SELECT dst AS id, list_sort(list(src)) AS l FROM edge GROUP BY dst),
d AS (SELECT u.id, CASE WHEN len(routes) > 0 THEN 'direct' WHEN tasked = 1 THEN 'direct' WHEN c.l IS NOT NULL THEN 'cites'
        WHEN b.l IS NOT NULL THEN 'cited-by' WHEN seen = 0 THEN 'unassessed' ELSE 'none' END AS basis,
        CASE WHEN len(routes) > 0 THEN routes WHEN tasked = 1 THEN ['task-' || (user_id % 3)] WHEN c.l IS NOT NULL THEN c.l[1:3]
        WHEN b.l IS NOT NULL THEN b.l[1:3] ELSE [] END AS names
      FROM u LEFT JOIN c ON c.id = u.id LEFT JOIN b ON b.id = u.id)
"""


def _scope(spark, sf_dir):
    e = raw_events(spark, sf_dir)
    seen = (F.col("event_type") == "scraped") & ((F.col("kind") == "view") | (F.col("k") % 30 == 1))
    users = e.groupBy("identity_key", "user_id").agg(
        F.array_sort(F.collect_set(F.when(seen, F.col("kind")))).alias("discovered_via"),
        F.max((F.col("kind") == "signup") & (F.col("k") % 40 == 2)).alias("tasked"),
    )
    task = F.when(F.col("tasked"), F.concat(F.lit('["task-'), F.col("user_id") % 3, F.lit('"]'))).otherwise("[]")
    rows = users.withColumn("effective", F.create_map(F.lit("task"), task))
    return graph.decide_scope(rows, _edges(spark, sf_dir), ["view"])


@query(
    "scope_decisions",
    SCOPE + """
SELECT id AS identity_key, basis AS inclusion_basis, array_to_string(names, ' ') AS names FROM d""",
)
def scope_decisions(spark, sf_dir):
    names = F.array_join(F.regexp_extract_all("inclusion_evidence", F.lit(r"(user\|\d+|task-\d+|click|purchase)"), 1), " ")
    return _scope(spark, sf_dir).select("identity_key", "inclusion_basis", names.alias("names"))


@query("scope_tally", SCOPE + "SELECT basis AS inclusion_basis, CAST(count(*) AS BIGINT) AS records FROM d GROUP BY basis")
def scope_tally(spark, sf_dir):
    return graph.scope_tally(_scope(spark, sf_dir))


@query(
    "touched_neighbours",
    EDGES + """
, t AS (SELECT DISTINCT id FROM e WHERE user_id % 25 = 7)
SELECT id AS identity_key FROM t UNION SELECT dst FROM edge WHERE src IN (SELECT id FROM t)
UNION SELECT src FROM edge WHERE dst IN (SELECT id FROM t)""",
)
def touched_neighbours(spark, sf_dir):
    touched = raw_events(spark, sf_dir).filter(F.col("user_id") % 25 == 7)
    return graph.neighbours(touched, _edges(spark, sf_dir))


# -- reconciliation ------------------------------------------------------------


@query(
    "shared_key_pairs",
    """WITH c AS (SELECT c_custkey, c_nationkey || '/' || c_mktsegment AS k,
      row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY CASE WHEN c_acctbal > 5000 THEN 0 ELSE 1 END, c_custkey) AS rn FROM customer)
    SELECT a.k AS key, CAST(a.c_custkey AS BIGINT) AS "primary", CAST(b.c_custkey AS BIGINT) AS secondary FROM c a JOIN c b ON a.k = b.k AND a.rn = 1 AND b.rn > 1""",
)
def shared_key_pairs(spark, sf_dir):
    claims = table(spark, sf_dir, "customer").select(
        F.concat_ws("/", "c_nationkey", "c_mktsegment").alias("key"),
        F.col("c_custkey").alias("identity_key"),
        F.struct(F.when(F.col("c_acctbal") > 5000, 0).otherwise(1).alias("kind"), "c_custkey").alias("rank"),
    )
    return reconcile.star_pairs(claims, "key")


@query(
    "primary_ranks",
    CLAIMS + """
SELECT key AS identity_key, CASE WHEN user_id % 4 = 0 THEN 0 ELSE 1 END AS kind,
       CASE WHEN user_id % 3 = 0 THEN 10 ELSE 20 END AS precedence, -1 AS systems FROM r""",
)
def primary_ranks(spark, sf_dir):
    ranks = reconcile.primary_rank(_claims(spark, sf_dir), SPEC)
    return ranks.select("identity_key", "rank.kind", "rank.precedence", "rank.systems")


@query(
    "shared_identifier_pairs",
    CLAIMS + """
, c AS (SELECT key, user_id, doi FROM r UNION SELECT key, user_id, key FROM r WHERE user_id % 4 = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY CASE WHEN user_id % 4 = 0 THEN 0 ELSE 1 END,
      CASE WHEN user_id % 3 = 0 THEN 10 ELSE 20 END, key) AS rn FROM c)
SELECT a.key AS "primary", b.key AS secondary, 'both identities assert DOI ' || a.doi AS evidence FROM o a JOIN o b ON a.doi = b.doi AND a.rn = 1 AND b.rn > 1""",
)
def shared_identifier_pairs(spark, sf_dir):
    return reconcile.shared_identifier_pairs(_claims(spark, sf_dir), SPEC).select("primary", "secondary", "evidence")


RELATIONS = LEDGER + """
, r AS (SELECT DISTINCT id, user_id, 'user|' || k AS other,
        CASE k % 5 WHEN 0 THEN 'IsIdenticalTo' WHEN 1 THEN 'Is-Preprint-Of' WHEN 2 THEN 'HasPreprint' WHEN 3 THEN 'IsVersionOf' ELSE 'References' END AS rel
        FROM e WHERE kind = 'click'),
known AS (SELECT DISTINCT id, user_id FROM e),
j AS (SELECT r.id, other, rel, r.user_id % 3 AS p, known.user_id % 3 AS op FROM r JOIN known ON known.id = r.other WHERE r.id <> other AND rel <> 'References'),
c AS (SELECT CASE WHEN (rel = 'IsIdenticalTo' AND (p, id) <= (op, other)) OR rel = 'HasPreprint' THEN id ELSE other END AS "primary",
       CASE WHEN (rel = 'IsIdenticalTo' AND (p, id) <= (op, other)) OR rel = 'HasPreprint' THEN other ELSE id END AS secondary,
       CASE rel WHEN 'IsIdenticalTo' THEN 'related-identifier' WHEN 'IsVersionOf' THEN 'version-pair' ELSE 'preprint-pair' END AS kind,
       CASE rel WHEN 'IsIdenticalTo' THEN 0.95::DOUBLE ELSE 0.99::DOUBLE END AS confidence FROM j)
"""


def _declared(spark, sf_dir):
    e = raw_events(spark, sf_dir)
    rel = F.element_at(
        F.array(*[F.lit(x) for x in ("IsIdenticalTo", "Is-Preprint-Of", "HasPreprint", "IsVersionOf", "References")]),
        F.col("k") % 5 + 1,
    )
    target = F.concat(F.lit("user|"), F.col("k"))
    stated = e.filter(F.col("kind") == "click").select(
        "identity_key", rel.alias("relation"), target.alias("identifier"), target.alias("target")
    ).distinct()
    users = e.select("identity_key", "user_id").distinct()
    ranks = users.select("identity_key", F.struct(F.col("user_id") % 3, "identity_key").alias("rank"))
    index = users.select(F.col("identity_key").alias("alias"), "identity_key")
    return reconcile.relation_candidates(stated, index, ranks)


@query("declared_pairs", RELATIONS + 'SELECT "primary", secondary, kind, confidence FROM c')
def declared_pairs(spark, sf_dir):
    return _declared(spark, sf_dir).select("primary", "secondary", "kind", "confidence")


@query(
    "one_decision_per_pair",
    RELATIONS + """
SELECT "primary", secondary, kind, confidence FROM (SELECT *, row_number() OVER (
  PARTITION BY least("primary", secondary), greatest("primary", secondary) ORDER BY confidence DESC, kind, "primary", secondary) AS rn FROM c) WHERE rn = 1""",
)
def one_decision_per_pair(spark, sf_dir):
    return reconcile.one_per_pair(_declared(spark, sf_dir)).select("primary", "secondary", "kind", "confidence")


@query(
    "same_titles",
    """WITH t AS (SELECT p_brand, p_size, p_name, min(p_partkey) AS head FROM part GROUP BY ALL),
    l AS (SELECT p.p_brand, p.p_size, t.head AS a, p.p_partkey AS b, 1.0::DOUBLE AS confidence
          FROM part p JOIN t USING (p_brand, p_size, p_name) WHERE p.p_partkey <> t.head
    -- in this word list only equal names, or names one leading letter apart (old, cold), come near
    UNION ALL SELECT x.p_brand, x.p_size, x.head, y.head, 2.0::DOUBLE * length(y.p_name) / (length(x.p_name) + length(y.p_name))
          FROM t x JOIN t y ON x.p_brand = y.p_brand AND x.p_size = y.p_size AND x.p_name <> y.p_name AND ends_with(x.p_name, y.p_name)
          AND 2.0 * length(y.p_name) / (length(x.p_name) + length(y.p_name)) >= 0.9)
    SELECT p_brand, p_size, CAST(least(a, b) AS BIGINT) AS "left", CAST(greatest(a, b) AS BIGINT) AS "right", confidence FROM l""",
)
def same_titles(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        "p_brand", "p_size", F.col("p_name").alias("title"), F.col("p_partkey").alias("identity_key")
    )
    return reconcile.fuzzy_pairs(parts, ["p_brand", "p_size"])


@query("fuzzy_titles")
def fuzzy_titles(spark, sf_dir):
    """Near-equal titles of pages of one language; the ratio has no SQL form."""
    from ledgerfold.functions.text import normalise_title

    pages = table(spark, sf_dir, "pages").select(
        F.regexp_extract("html", r'<html lang="([a-z]+)"', 1).alias("lang"),
        F.col("page_id").alias("identity_key"),
        normalise_title(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)).alias("title"),
    )
    return reconcile.fuzzy_pairs(pages, ["lang"])


@query(
    "components",
    """WITH RECURSIVE p AS (
      SELECT c_custkey AS a, c_custkey + 1 AS b FROM customer WHERE c_custkey % 10 < 7
      UNION SELECT c_custkey, c_custkey - 10 FROM customer WHERE c_acctbal > 9000 AND c_custkey >= 10),
    s AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
    r(node, label) AS (SELECT DISTINCT a, a FROM s UNION SELECT s.b, r.label FROM r JOIN s ON s.a = r.node)
    SELECT CAST(node AS BIGINT) AS node, CAST(min(label) AS BIGINT) AS component FROM r GROUP BY node""",
)
def components(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    pairs = c.filter(key % 10 < 7).select(key.alias("a"), (key + 1).alias("b")).unionByName(
        c.filter((F.col("c_acctbal") > 9000) & (key >= 10)).select(key.alias("a"), (key - 10).alias("b"))
    )
    return reconcile.connected_components(pairs, "a", "b")


MERGES = """
WITH k AS (SELECT c_custkey AS c, printf('c%08d', c_custkey) AS id FROM customer),
x AS (
  SELECT printf('c%08d', c // 10 * 10) AS "primary", id AS secondary, 'related-identifier' AS kind, c FROM k WHERE c % 10 BETWEEN 1 AND 3
  UNION ALL SELECT printf('c%08d', c // 100 * 100), id, 'version-pair', c FROM k WHERE c % 10 = 0 AND c % 100 <> 0
  UNION ALL SELECT printf('c%08d', c // 1000 * 1000), id, 'preprint-pair', c FROM k WHERE c % 100 = 0 AND c % 1000 <> 0
  UNION ALL SELECT printf('c%08d', c // 10 * 10 + 5), id, 'preprint-pair', c FROM k WHERE c % 10 = 3 AND c % 4 = 0),
f AS (SELECT *, min((kind, "primary", secondary)) OVER (PARTITION BY secondary) AS first FROM x),
plan AS (SELECT "primary", secondary, kind, c FROM f WHERE NOT (c % 4 = 1 AND kind = 'related-identifier' AND first = (kind, "primary", secondary)))
"""


def _merge_plan(spark, sf_dir):
    c = F.col("c_custkey")
    ident = lambda n: F.format_string("c%08d", n.cast("bigint"))
    down = lambda step: (F.floor(c / step) * step)
    t = table(spark, sf_dir, "customer")

    def cand(rows, primary, kind):
        return rows.select(
            ident(primary).alias("primary"), ident(c).alias("secondary"), F.lit(kind).alias("kind"),
            F.lit(0.99).alias("confidence"), F.lit("stated").alias("evidence"), F.lit(True).alias("automatic"),
        )

    cands = (
        cand(t.filter((c % 10).between(1, 3)), down(10), "related-identifier")
        .unionByName(cand(t.filter((c % 10 == 0) & (c % 100 != 0)), down(100), "version-pair"))
        .unionByName(cand(t.filter((c % 100 == 0) & (c % 1000 != 0)), down(1000), "preprint-pair"))
        .unionByName(cand(t.filter((c % 10 == 3) & (c % 4 == 0)), down(10) + 5, "preprint-pair"))
    )
    standing = cand(t.filter((c % 10).between(1, 3) & (c % 4 == 1)), down(10), "related-identifier")
    return reconcile.plan_merges(cands, standing)


@query("merge_plan", MERGES + 'SELECT "primary", secondary, kind FROM plan')
def merge_plan(spark, sf_dir):
    return _merge_plan(spark, sf_dir).select("primary", "secondary", "kind")


@query(
    "merge_urls",
    MERGES.replace("WITH k", "WITH RECURSIVE k") + """
, own AS (SELECT id, 'https://example.org/' || c AS url FROM k WHERE c % 2 = 0),
r(id, url, since) AS (SELECT id, url, ('', '', '') FROM own
  UNION SELECT p."primary", r.url, (p.kind, p."primary", p.secondary) FROM r JOIN plan p ON p.secondary = r.id AND (p.kind, p."primary", p.secondary) > r.since),
m AS (SELECT id, url, min(since) AS since FROM r GROUP BY id, url)
SELECT p."primary", p.secondary, m.url FROM plan p JOIN m ON m.id = p.secondary WHERE m.since < (p.kind, p."primary", p.secondary)""",
)
def merge_urls(spark, sf_dir):
    c = F.col("c_custkey")
    urls = table(spark, sf_dir, "customer").filter(c % 2 == 0).select(
        F.format_string("c%08d", c).alias("identity_key"), F.concat(F.lit("https://example.org/"), c).alias("url")
    )
    return reconcile.merge_urls(_merge_plan(spark, sf_dir), urls).select("primary", "secondary", "url")


@query(
    "promotions",
    """WITH cand AS (SELECT c_custkey AS id, 'task-' || (c_custkey % 60) AS v FROM customer),
    reg AS (SELECT 'task-' || n_nationkey AS name, 'task-' || (n_nationkey + 30) AS alias FROM nation),
    look AS (SELECT name AS k, name FROM reg UNION ALL SELECT alias, name FROM reg WHERE alias NOT IN (SELECT name FROM reg)),
    held AS (SELECT c_custkey AS id, 'task-' || (c_nationkey + 30) AS v FROM customer)
    SELECT CAST(cand.id AS BIGINT) AS identity_key, look.name AS task FROM cand JOIN look ON look.k = cand.v
    WHERE NOT EXISTS (SELECT 1 FROM held JOIN look l2 ON l2.k = held.v WHERE held.id = cand.id AND l2.name = look.name)""",
)
def promotions(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    cands = c.select(
        F.col("c_custkey").alias("identity_key"), F.lit(0).alias("pos"),
        F.concat(F.lit("Task 0"), F.col("c_custkey") % 60).alias("value"),
    )
    held = c.select(F.col("c_custkey").alias("identity_key"), F.concat(F.lit("task-"), F.col("c_nationkey") + 30).alias("value"))
    n = F.col("n_nationkey")
    groups = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("task-"), n).alias("name"), F.array(F.concat(F.lit("task-"), n + 30)).alias("aliases")
    )
    return reconcile.promotions(cands, held, groups).select("identity_key", "task")


# -- curation ------------------------------------------------------------------


@query(
    "annotation_outcomes",
    LEDGER + """
, a AS (SELECT seq, 'user|' || (user_id * 2) AS id, k % 25 = 0 AS allow,
        substr(sha256('{"actor":"curator","identity_key":"user|' || (user_id * 2) || '","local":{"pinned":' ||
          CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END || ',"task":["task-' || (k % 4) || '"]},"note":""}'), 1, 16) AS fp
        FROM e WHERE kind = 'signup'),
known AS (SELECT DISTINCT id FROM e),
rec AS (SELECT DISTINCT id, fp FROM a WHERE seq % 50 = 0),
o AS (SELECT id, min(seq) AS opened FROM a WHERE allow AND (id, fp) NOT IN (SELECT (id, fp) FROM rec) GROUP BY id),
j AS (SELECT a.*, r.id IS NOT NULL AS recorded, k.id IS NOT NULL OR coalesce(a.seq >= o.opened, false) AS eligible
      FROM a LEFT JOIN rec r ON r.id = a.id AND r.fp = a.fp LEFT JOIN known k ON k.id = a.id LEFT JOIN o ON o.id = a.id),
f AS (SELECT id, fp, min(seq) AS first FROM j WHERE eligible AND NOT recorded GROUP BY id, fp)
SELECT CAST(j.seq AS BIGINT) AS pos, j.fp AS fingerprint, CASE WHEN recorded THEN 'skipped' WHEN NOT eligible THEN 'pending'
  WHEN j.seq = f.first THEN 'applied' ELSE 'skipped' END AS outcome FROM j LEFT JOIN f ON f.id = j.id AND f.fp = j.fp""",
)
def annotation_outcomes(spark, sf_dir):
    e = raw_events(spark, sf_dir)
    key = F.concat(F.lit("user|"), F.col("user_id") * 2)
    local = F.concat(
        F.lit('{"pinned":'), (F.col("k") % 2 == 0).cast("string"), F.lit(',"task":["task-'), F.col("k") % 4, F.lit('"]}')
    )
    none = F.lit(None).cast("string")
    rows = e.filter(F.col("kind") == "signup").select(
        key.alias("identity_key"), F.col("seq").alias("pos"),
        curation.fingerprint(key, local, none, none).alias("fingerprint"), (F.col("k") % 25 == 0).alias("allow_new"),
    )
    planned = curation.plan_annotations(rows, e, rows.filter(F.col("pos") % 50 == 0))
    return planned.select("pos", "fingerprint", "outcome")


@query(
    "annotated_fields",
    LEDGER + "SELECT DISTINCT 'f' || (k % 6) AS field FROM e WHERE kind = 'signup'",
)
def annotated_fields(spark, sf_dir):
    e = raw_events(spark, sf_dir).filter(F.col("kind") == "signup")
    return curation.annotated_fields(e.select(F.concat(F.lit('{"f'), F.col("k") % 6, F.lit('":1}')).alias("local")))


@query(
    "pin_conflicts",
    LEDGER + """
, last AS (SELECT id, arg_max('t' || CAST(floor(value / 50) AS BIGINT), (ts, seq)) AS token FROM e WHERE system IS NOT NULL GROUP BY id),
pin AS (SELECT id, arg_max(k % 2 = 0, (ts, seq)) AS pinned, arg_max('t' || (k % 3), (ts, seq)) AS pin FROM e WHERE kind = 'signup' GROUP BY id),
told AS (SELECT DISTINCT id, 't' || (k % 3) AS token FROM e WHERE kind = 'error' AND k < 5)
SELECT last.id AS identity_key, last.token AS source_key, pin.pin AS pin_source_key FROM last JOIN pin USING (id)
WHERE pinned AND pin <> token AND NOT EXISTS (SELECT 1 FROM told WHERE told.id = last.id AND told.token = last.token)""",
)
def pin_conflicts(spark, sf_dir):
    e = raw_events(spark, sf_dir)
    kn = F.col("k")
    body = F.concat(F.lit('{"pinned":'), (kn % 2 == 0).cast("string"), F.lit(',"pin_source_key":"t'), kn % 3, F.lit('"}'))
    told = F.concat(F.lit('{"observed_source_key":"t'), kn % 3, F.lit('"}'))
    events = ledger.event_frame(
        e.filter((F.col("kind") != "error") | (kn < 5)).withColumns(
            {
                "event_type": F.when(F.col("kind") == "error", "pin_notice").otherwise(F.col("event_type")),
                "source_key": F.concat(F.lit("t"), F.floor(F.col("value") / 50).cast("string")),
                "local": F.when(F.col("kind") == "signup", body).otherwise("{}"),
                "notice": F.when(F.col("kind") == "error", told),
            }
        )
    )
    notices = curation.pin_notices(rs.resolve(events, SPEC), events)
    return notices.select(
        "identity_key", F.get_json_object("notice", "$.observed_source_key").alias("source_key"),
        F.get_json_object("notice", "$.pin_source_key").alias("pin_source_key"),
    )


@query(
    "tombstones",
    LEDGER + """
, s AS (SELECT id, obs, seq, k, CASE WHEN k % 3 = 0 THEN 410 WHEN k % 3 = 1 THEN 404 ELSE 200 END AS code FROM e WHERE kind = 'view'),
told AS (SELECT DISTINCT id FROM e WHERE kind = 'error' AND k < 3)
SELECT id AS identity_key, min(obs) AS observed_at FROM s WHERE code <> 200 AND NOT (code = 404 AND k % 2 = 0) AND id NOT IN (SELECT id FROM told) GROUP BY id""",
)
def tombstones(spark, sf_dir):
    e = raw_events(spark, sf_dir)
    code = F.when(F.col("k") % 3 == 0, 410).when(F.col("k") % 3 == 1, 404).otherwise(200)
    body = F.when(F.col("k") % 3 == 0, '{"tombstone":{"removal_reason":{"id":"spam"}}}').when(
        F.col("k") % 2 == 0, '{"status":"moved"}'
    ).otherwise("<html>")
    checks = e.filter(F.col("kind") == "view").select(
        "identity_key", F.lit("zenodo").alias("source_system"), code.alias("status_code"), body.alias("payload"), "observed_at"
    )
    events = ledger.event_frame(e.filter((F.col("kind") == "error") & (F.col("k") < 3)))
    return curation.withdrawals_from_tombstones(checks, events).select("identity_key", "observed_at")


@query(
    "event_history",
    LEDGER + """
SELECT id AS identity_key, CAST(seq AS BIGINT) AS seq, CASE kind WHEN 'signup' THEN 'Local annotation added'
  WHEN 'error' THEN 'Artifact no longer available at the source' ELSE 'Upstream metadata observed and taken wholesale' END AS description FROM e""",
)
def event_history(spark, sf_dir):
    return listing.event_history(ledger_view(spark, sf_dir)).select("identity_key", "seq", "description")


# -- reports -------------------------------------------------------------------


@query(
    "source_counters",
    LEDGER + """
SELECT system AS source, CAST(count(*) AS BIGINT) AS seen, CAST(count(*) FILTER (k % 4 = 1 AND k % 11 <> 0) AS BIGINT) AS changed,
  CAST(count(*) FILTER (k % 4 <> 1 AND k % 11 <> 0) AS BIGINT) AS skipped_unchanged, CAST(count(*) FILTER (k % 11 = 0) AS BIGINT) AS errors
FROM e WHERE system IS NOT NULL GROUP BY system""",
)
def source_counters(spark, sf_dir):
    return reports.source_counters(_outcomes(spark, sf_dir))


def _outcomes(spark, sf_dir):
    e = raw_events(spark, sf_dir).filter(F.col("event_type") == "scraped")
    return e.select(
        F.col("source_system").alias("source"), (F.col("k") % 4 == 1).alias("changed"),
        F.when(F.col("k") % 11 == 0, "map failed").alias("error"),
    )


@query(
    "run_report",
    LEDGER + """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM e WHERE system IS NOT NULL AND k % 4 = 1 AND k % 11 <> 0) AS events_appended,
  (SELECT CAST(count(DISTINCT id) AS BIGINT) FROM e) AS records_total,
  (SELECT round(count(*) FILTER (k % 3 = 0) / count(*), 4) FROM e WHERE kind = 'view') AS hit_rate,
  (SELECT CAST(count(*) AS BIGINT) FROM e WHERE kind = 'view' AND k % 3 <> 0) AS pending_extraction, true AS ok""",
)
def run_report(spark, sf_dir):
    e = raw_events(spark, sf_dir)
    views = e.filter(F.col("kind") == "view").select((F.col("k") % 3 == 0).alias("hit"))
    actions = e.select("identity_key").distinct().select(F.lit("written").alias("action"))
    tally = graph.scope_tally(_scope(spark, sf_dir))
    row = reports.run_report(
        spark, reports.source_counters(_outcomes(spark, sf_dir)), actions, tally, views,
        views.filter(~F.col("hit")), views.filter(F.lit(False)), "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z",
    )
    return row.select("events_appended", "records_total", "hit_rate", "pending_extraction", "ok")


@query(
    "freshness",
    """SELECT strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS finished_at,
      CAST(floor((epoch(TIMESTAMP '2024-06-01') - floor(epoch(max(ts)))) / 86400) AS BIGINT) AS age_days,
      floor((epoch(TIMESTAMP '2024-06-01') - floor(epoch(max(ts)))) / 86400) >= 45 AS stale, false AS never_run FROM events""",
)
def freshness(spark, sf_dir):
    ends = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("finished_at"))
    return reports.freshness(ends, F.lit("2024-06-01 00:00:00").cast("timestamp"))


@query(
    "daily_counts",
    """SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, CAST(count(*) AS BIGINT) AS events FROM events GROUP BY 1, 2""",
)
def daily_counts(spark, sf_dir):
    from ledgerfold.streaming.monitor import events_per_window

    counts = events_per_window(
        table(spark, sf_dir, "events").withColumn("source_system", F.lit(None).cast("string")), "ts", "1 day"
    )
    return counts.select(F.col("window_start").alias("day"), "event_type", "events")


@query(
    "published_packages",
    FOLD + """
, t AS (SELECT id, 'k' || (k % 20) AS tag FROM last UNION SELECT id, 'k' || (k % 20) FROM e WHERE kind = 'signup'),
g AS (SELECT id, string_agg(tag, ',' ORDER BY tag) AS tags FROM t GROUP BY id),
f AS (SELECT id, any_value(user_id) AS user_id, max((kind = 'error')::INT) = 1 AS gone, count(system) > 0 AS scraped FROM e GROUP BY id)
SELECT f.id AS identity_key, 'user-' || user_id AS name, f.id AS title, 'notspecified' AS license_id, coalesce(tags, '') AS tags, 'unattributed' AS owner_org,
  CASE WHEN gone THEN 'withdrawn' ELSE 'active' END AS lifecycle, CASE WHEN scraped THEN 'direct' ELSE 'unassessed' END AS inclusion_basis
FROM f LEFT JOIN g ON g.id = f.id""",
)
def published_packages(spark, sf_dir):
    from ledgerfold.operators import packages
    from ledgerfold.plans.runs import fold

    events = ledger_view(spark, sf_dir)
    resolved = fold(events, SPEC)
    scope = graph.decide_scope(resolved, None, [])
    slugs = packages.allocate_slugs(events.groupBy("identity_key").agg(F.min("seq").alias("first_seq")))
    names = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("pos"), F.lower("n_name").alias("name"), F.col("n_name").alias("title"),
        F.array().cast("array<string>").alias("aliases"),
    )
    built, _ = packages.build_packages(resolved, scope, slugs, names, names, SPEC)
    return built.select(
        "identity_key", "name", "title", "license_id", F.array_join(F.transform("tags", lambda t: t["name"]), ",").alias("tags"),
        "owner_org", packages.extra("lifecycle_state").alias("lifecycle"), packages.extra("inclusion_basis").alias("inclusion_basis"),
    )
