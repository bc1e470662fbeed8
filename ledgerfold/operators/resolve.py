"""Folding a ledger into the current state of every identity.

The big table is shuffled once, to ``(identity, system)`` with map-side partial
aggregation, so a hot identity shrinks to one row per system before it moves.
Payloads are taken apart only after that, when one block per system is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerfold.functions import text as tx
from ledgerfold.functions.jsonval import get_doc, is_empty, json_array, json_type, quote
from ledgerfold.operators.ledger import log_order
from ledgerfold.spec import (
    NOTICE_EVENT_TYPES,
    SEEN_EVENT_TYPES,
    UNKNOWN_PRECEDENCE,
    LedgerSpec,
)

def _scraped() -> Column:
    return F.col("event_type") == "scraped"


def precedence_of(system: Column, spec: LedgerSpec) -> Column:
    """Declared rank of a system; lower wins, unknown systems come last."""
    ranks = F.create_map(*[F.lit(x) for pair in spec.precedence.items() for x in pair])
    return F.coalesce(F.element_at(ranks, system), F.lit(UNKNOWN_PRECEDENCE))


def system_state(events: DataFrame, spec: LedgerSpec) -> DataFrame:
    """One row per (identity, system): last scrape, last withdrawal claim, counters.

    A withdrawal with no system is filed under the empty system, which no scrape
    can lift. Only a JSON boolean claims or lifts a withdrawal.
    """
    field = spec.withdrawal_field
    claim = F.when(
        F.col("source").contains(f'"{field}"'),
        F.to_json(get_doc(F.try_parse_json("source"), f"$.{field}")),
    )
    says = (
        F.when(F.col("event_type") == "withdrawn", F.lit(True))
        .when(_scraped() & (claim == "true"), F.lit(True))
        .when(_scraped() & (claim == "false"), F.lit(False))
    )
    seen = F.col("event_type").isin(*SEEN_EVENT_TYPES)
    rows = events.select(
        "*",
        F.coalesce("source_system", F.when(_scraped(), "unknown").otherwise("")).alias("system"),
        says.alias("says_withdrawn"),
    )
    return rows.groupBy("identity_key", "system").agg(
        F.count(F.lit(1)).alias("events"),
        F.min(F.when(seen, F.col("observed_at"))).alias("first_seen"),
        F.max(F.when(seen, F.col("observed_at"))).alias("last_seen"),
        F.max_by(
            F.struct("source", "source_key", "source_id", "source_system", "observed_at", "seq"),
            F.when(_scraped(), log_order()),
        ).alias("last"),
        F.max_by(
            F.struct("says_withdrawn", "observed_at"),
            F.when(F.col("says_withdrawn").isNotNull(), log_order()),
        ).alias("claim"),
    )


def latest_scrapes(state: DataFrame) -> DataFrame:
    """The standing scrape of every (identity, system)."""
    return state.filter(F.col("last").isNotNull()).select("identity_key", "system", "last.*")


def identity_facts(state: DataFrame) -> DataFrame:
    """Seen dates, counts, systems, last scrape and standing withdrawal per identity."""
    stands = F.col("claim.says_withdrawn")
    last_order = F.when(
        F.col("last").isNotNull(), F.struct(F.col("last.observed_at"), F.col("last.seq"))
    )
    facts = state.groupBy("identity_key").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum("events").alias("event_count"),
        F.array_sort(
            F.collect_set(F.when(F.col("last").isNotNull(), F.col("system")))
        ).alias("source_systems"),
        F.max_by(F.col("last"), last_order).alias("last"),
        F.min(F.when(stands, F.col("claim.observed_at"))).alias("withdrawn_at"),
    )
    return facts.select(
        "identity_key",
        "first_seen",
        "last_seen",
        "event_count",
        "source_systems",
        F.col("last.source_key").alias("source_key"),
        F.col("last.source_system").alias("source_system"),
        F.col("last.source_id").alias("source_id"),
        F.col("withdrawn_at").isNotNull().alias("withdrawn"),
        "withdrawn_at",
    )


def _exploded(rows: DataFrame, doc: str) -> DataFrame:
    """One row per field of a JSON object column, value as canonical JSON."""
    spark = rows.sparkSession
    parsed = rows.withColumn("_doc", F.try_parse_json(doc)).drop(doc)
    return (
        parsed.lateralJoin(spark.tvf.variant_explode(F.col("_doc").outer()))
        .withColumn("value", F.to_json("value"))
        .withColumnRenamed("key", "field")
        .drop("_doc", "pos")
    )


def source_fields(state: DataFrame, spec: LedgerSpec) -> DataFrame:
    """Fields of the standing scrapes with ``rank_pos``: 1 for the worst-ranked
    system of the identity, rising to the best."""
    blocks = latest_scrapes(state).select(
        "identity_key", "system", precedence_of(F.col("system"), spec).alias("_rank"), "source"
    )
    worst_first = W.partitionBy("identity_key").orderBy(
        F.col("_rank").desc(), F.col("system").desc()
    )
    ranked = blocks.withColumn("rank_pos", F.row_number().over(worst_first)).drop("_rank")
    return _exploded(ranked, "source")


def local_fields(events: DataFrame) -> DataFrame:
    """Fields set by annotations, one row per event and field."""
    says = (F.col("event_type") == "annotated") & (F.col("local") != "{}")
    rows = events.filter(says).select("identity_key", "observed_at", "seq", "local")
    return _exploded(rows, "local")


def compose_scalars(fields: DataFrame, spec: LedgerSpec) -> DataFrame:
    """Best-ranked non-empty value per field; all empty keeps the worst rank's."""
    bag = F.col("field").isin(*spec.bag_fields) & F.col("value").startswith("{")
    rows = fields.filter(~F.col("field").isin(*spec.set_fields) & ~bag)
    return rows.groupBy("identity_key", "field").agg(
        F.coalesce(
            F.max_by("value", F.when(~is_empty(F.col("value")), F.col("rank_pos"))),
            F.min_by("value", "rank_pos"),
        ).alias("value")
    )


def compose_bags(fields: DataFrame, spec: LedgerSpec) -> DataFrame:
    """Bag fields merged key by key, best-ranked non-empty value per key."""
    bags = fields.filter(F.col("field").isin(*spec.bag_fields) & F.col("value").startswith("{"))
    inner = _exploded(bags.withColumnRenamed("field", "bag"), "value")
    best = (
        inner.filter(~is_empty(F.col("value")))
        .groupBy("identity_key", "bag", "field")
        .agg(F.max_by("value", "rank_pos").alias("value"))
    )
    whole = best.groupBy("identity_key", F.col("bag").alias("field")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("field").alias("k"), F.col("value").alias("v")))).alias("kv")
    )
    return whole.select(
        "identity_key",
        "field",
        F.concat(
            F.lit("{"),
            F.array_join(F.transform("kv", lambda p: F.concat(quote(p["k"]), F.lit(":"), p["v"])), ","),
            F.lit("}"),
        ).alias("value"),
    )


def _items(value: Column) -> Column:
    doc = F.try_parse_json(value)
    return F.when(json_type(doc) == "STRING", F.when(value != '""', F.array(value))).otherwise(
        F.transform(F.try_variant_get(doc, "$", "array<variant>"), lambda v: F.to_json(v))
    )


def set_tokens(source: DataFrame, local: DataFrame, spec: LedgerSpec) -> DataFrame:
    """Distinct members of set-valued fields with their first place.

    Source members come first, worst-ranked system first and array order inside;
    local members follow in event order. ``place`` orders them; no group is
    collected here, so a set may grow without bound.
    """
    is_set = F.col("field").isin(*spec.set_fields)
    src = source.filter(is_set).select(
        "identity_key",
        "field",
        F.lit(0).alias("ns"),
        F.lit("").alias("t"),
        F.col("rank_pos").cast("bigint").alias("s"),
        F.posexplode(_items(F.col("value"))).alias("p", "token"),
    )
    loc = local.filter(is_set).select(
        "identity_key",
        "field",
        F.lit(1).alias("ns"),
        F.col("observed_at").alias("t"),
        F.col("seq").alias("s"),
        F.posexplode(_items(F.col("value"))).alias("p", "token"),
    )
    both = src.unionByName(loc)
    place = F.struct("ns", "t", "s", "p")
    return both.groupBy("identity_key", "field", "token").agg(
        F.min(place).alias("place"), F.min(F.when(F.col("ns") == 1, place)).alias("local_place")
    )


def local_state(local: DataFrame, spec: LedgerSpec) -> DataFrame:
    """Latest annotation per scalar field; a null overwrites like any value."""
    return (
        local.filter(~F.col("field").isin(*spec.set_fields))
        .groupBy("identity_key", "field")
        .agg(F.max_by("value", log_order()).alias("value"))
    )


def effective_fields(
    scalars: DataFrame, local: DataFrame
) -> DataFrame:
    """Source value unless empty, else the local one, with the displaced local value."""
    both = scalars.select("identity_key", "field", F.col("value").alias("s"), F.lit(None).cast("string").alias("l")).unionByName(
        local.select("identity_key", "field", F.lit(None).cast("string").alias("s"), F.col("value").alias("l"))
    )
    joined = both.groupBy("identity_key", "field").agg(F.max("s").alias("s"), F.max("l").alias("l"))
    has_source, has_local = ~is_empty(F.col("s")), ~is_empty(F.col("l"))
    return joined.select(
        "identity_key",
        "field",
        F.col("s").alias("source_value"),
        F.col("l").alias("local_value"),
        F.when(has_source, F.col("s")).when(F.col("l") != "null", F.col("l")).alias("effective_value"),
        (has_source & has_local & (F.col("s") != F.col("l"))).alias("displaced"),
    )


def provenance_fields(events: DataFrame, state: DataFrame) -> DataFrame:
    """Who set each field last, in time rather than by rank.

    A setter stops counting when the system it is stamped with scrapes again
    without it. Annotations fill the fields no source accounts for.
    """
    entries = events.select(
        "identity_key", "event_type", "source_system", "observed_at", "seq",
        F.explode("provenance").alias("field", "p"),
    )
    stamp = F.coalesce(
        tx.blank_to_null(F.col("p.source_system")), F.col("source_system"), F.lit("unknown")
    )
    setters = (
        entries.filter(_scraped())
        .withColumn("stamp", stamp)
        .groupBy("identity_key", "field")
        .agg(F.max_by(F.struct("p", "stamp", "observed_at", "seq"), log_order()).alias("x"))
        .select("identity_key", "field", "x.*")
    )
    scrapes = latest_scrapes(state).select(
        "identity_key",
        F.col("system").alias("stamp"),
        F.struct("observed_at", "seq").alias("scraped_at"),
    )
    standing = setters.join(scrapes, ["identity_key", "stamp"], "left").filter(
        F.col("scraped_at").isNull() | (F.col("scraped_at") <= F.struct("observed_at", "seq"))
    )
    from_source = standing.select(
        "identity_key", "field", F.col("p").withField("source_system", F.col("stamp")).alias("p"),
        F.lit(0).alias("ns"),
    )
    from_local = (
        entries.filter(F.col("event_type") == "annotated")
        .groupBy("identity_key", "field")
        .agg(F.max_by("p", log_order()).alias("p"))
        .select("identity_key", "field", "p", F.lit(1).alias("ns"))
    )
    return (
        from_source.unionByName(from_local)
        .groupBy("identity_key", "field")
        .agg(F.min_by("p", "ns").alias("entry"))
    )


def discovery_routes(events: DataFrame) -> DataFrame:
    """Distinct routes per identity with their first place in the log."""
    routes = events.filter(_scraped()).select(
        "identity_key", "observed_at", "seq", F.posexplode("discovered_via").alias("p", "route")
    )
    return routes.groupBy("identity_key", "route").agg(
        F.min(F.struct("observed_at", "seq", "p")).alias("place")
    )


def notices(events: DataFrame, effective: DataFrame) -> DataFrame:
    """Stated notices in log order, then the displacements the fold implies."""
    stated = events.filter(F.col("event_type").isin(*NOTICE_EVENT_TYPES)).select(
        "identity_key",
        F.col("event_type").alias("type"),
        "observed_at",
        "seq",
        F.lit(None).cast("string").alias("field"),
        F.coalesce("notice", F.lit("{}")).alias("detail"),
        F.lit(False).alias("implicit"),
    )
    implied = effective.filter("displaced").select(
        "identity_key",
        F.lit("displacement").alias("type"),
        F.lit(None).cast("string").alias("observed_at"),
        F.lit(None).cast("bigint").alias("seq"),
        "field",
        F.concat(
            F.lit('{"displaced_local_value":'), F.col("local_value"),
            F.lit(',"source_value":'), F.col("source_value"), F.lit("}"),
        ).alias("detail"),
        F.lit(True).alias("implicit"),
    )
    return stated.unionByName(implied)


def _as_map(rows: DataFrame, value: str, name: str) -> DataFrame:
    return (
        rows.filter(F.col(value).isNotNull())
        .groupBy("identity_key")
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", value)))).alias(name))
    )


def resolve(
    events: DataFrame, spec: LedgerSpec | None = None, state: DataFrame | None = None
) -> DataFrame:
    """One row per identity: facts plus source, local and effective fields.

    ``state`` is :func:`system_state` when the caller has stored it already. Facts,
    fields and provenance each need other columns of it, so left to itself the
    planner would aggregate the ledger once for each; runs store it first.

    Field maps hold canonical JSON values. A record's own lists are arrays here
    because the record is the row; :func:`set_tokens` and the other long forms
    serve anything that should not be one value.
    """
    spec = spec or LedgerSpec()
    state = system_state(events, spec) if state is None else state
    fields = source_fields(state, spec)
    local = local_fields(events)
    scalars = compose_scalars(fields, spec).unionByName(compose_bags(fields, spec))
    effective = effective_fields(scalars, local_state(local, spec))
    tokens = set_tokens(fields, local, spec)
    ordered = lambda place, rows: F.transform(
        F.array_sort(F.collect_list(F.when(rows, F.struct(F.col(place).alias("place"), "token")))),
        lambda m: m["token"],
    )
    sets = tokens.groupBy("identity_key", "field").agg(
        json_array(ordered("place", F.col("place.ns") == 0)).alias("source_value"),
        json_array(ordered("local_place", F.col("local_place").isNotNull())).alias("local_value"),
        json_array(ordered("place", F.lit(True))).alias("effective_value"),
    )
    values = effective.drop("displaced").unionByName(sets)
    maps = values.groupBy("identity_key").agg(
        *[
            F.map_from_entries(
                F.array_sort(F.collect_list(F.when(F.col(v).isNotNull(), F.struct("field", v))))
            ).alias(v.removesuffix("_value"))
            for v in ("source_value", "local_value", "effective_value")
        ]
    )
    routes = (
        discovery_routes(events)
        .groupBy("identity_key")
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("place", "route"))), lambda r: r["route"]
            ).alias("discovered_via")
        )
    )
    none = F.create_map().cast("map<string,string>")
    facts = identity_facts(state)
    return (
        facts.join(maps, "identity_key", "left")
        .join(_as_map(provenance_fields(events, state), "entry", "provenance"), "identity_key", "left")
        .join(routes, "identity_key", "left")
        .select(
            *facts.columns,
            F.coalesce("source", none).alias("source"),
            F.coalesce("local", none).alias("local"),
            F.coalesce("effective", none).alias("effective"),
            "provenance",
            F.coalesce("discovered_via", F.array().cast("array<string>")).alias("discovered_via"),
        )
    )
