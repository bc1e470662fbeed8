"""Change detection: only observations whose token moved become events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.jsonval import canonical
from ledgerfold.operators.skew import previous_value
from ledgerfold.spec import LedgerSpec


def payload_hash(payload: Column) -> Column:
    """Sixteen hex digits over canonical JSON: the fallback change token."""
    return F.substring(F.sha2(canonical(payload), 256), 1, 16)


def stamp(token: Column, mapping_version: int) -> Column:
    """The token with the mapping version, so a better mapping re-emits each row once."""
    return F.concat(token, F.lit(f"~m{mapping_version}"))


def last_tokens(events: DataFrame) -> DataFrame:
    """The token of the last scrape, by observation time, per identity and system."""
    return (
        events.filter(F.col("event_type") == "scraped")
        .groupBy("identity_key", "source_system")
        .agg(
            F.max_by(F.struct("source_key"), F.struct("observed_at", "seq")).alias("last"),
        )
        .select("identity_key", "source_system", F.col("last.source_key").alias("stored_key"))
    )


def changed_rows(
    observations: DataFrame, stored: DataFrame, spec: LedgerSpec | None = None
) -> DataFrame:
    """Observations whose token differs from the one before them.

    The row before is the previous observation of the same identity and system in
    this batch, or the stored token for the first. A token may go k1, k2, k1: each
    move is a change, so tokens are compared along time, never as a set.
    """
    spec = spec or LedgerSpec()
    keys = ["identity_key", "source_system"]
    segment = F.substring("observed_at", 1, spec.segment_chars)
    looked = previous_value(observations, keys, segment, ["observed_at", "seq"], "source_key")
    first = looked.filter(~F.col("has_previous"))
    later = looked.filter("has_previous")
    known = first.join(stored, keys, "left").withColumn("previous", F.col("stored_key"))
    moved = ~F.col("source_key").eqNullSafe(F.col("previous"))
    cols = observations.columns
    return later.filter(moved).select(*cols).unionByName(known.filter(moved).select(*cols))


def backfill_queue(events: DataFrame, system: str, pattern: str) -> DataFrame:
    """Identities with an identifier of a system that never scraped them.

    The identifier is the last one any scrape stated.
    """
    from ledgerfold.functions import text as tx
    from ledgerfold.functions.jsonval import get_text

    scrapes = events.filter(F.col("event_type") == "scraped").select(
        "identity_key",
        F.coalesce("source_system", F.lit("")).alias("source_system"),
        tx.blank_to_null(get_text(F.try_parse_json("source"), "$.doi")).alias("doi"),
        F.struct("observed_at", "seq").alias("at"),
    )
    seen = scrapes.groupBy("identity_key").agg(
        F.max(F.col("source_system") == system).alias("scraped"),
        F.max_by("doi", F.when(F.col("doi").isNotNull(), F.col("at"))).alias("doi"),
    )
    record = F.regexp_extract(tx.normalise_doi(F.col("doi")), pattern, 1)
    return (
        seen.filter(~F.col("scraped"))
        .withColumn("source_id", record)
        .filter(F.col("source_id") != "")
        .select("identity_key", "source_id", tx.slug_for_identity(F.col("identity_key")).alias("slug"))
    )


def routeless(events: DataFrame, system: str) -> DataFrame:
    """Identities no scrape of which recorded a discovery route, with their id at a system."""
    own = F.col("source_system") == system
    return (
        events.filter(F.col("event_type") == "scraped")
        .groupBy("identity_key")
        .agg(
            F.max(F.size("discovered_via")).alias("routes"),
            F.max_by("source_id", F.when(own, F.struct("observed_at", "seq"))).alias("source_id"),
        )
        .filter((F.col("routes") <= 0) & (F.coalesce("source_id", F.lit("")) != ""))
        .select("identity_key", "source_id")
    )


def confirm_routes(pending: DataFrame, evidence: DataFrame, missing: str = "query:no-match") -> DataFrame:
    """Routes an index confirmed for each pending id, else the sentinel route.

    ``evidence`` is ``(source_id, route, pos, matched)``; an id nothing was asked
    about is left out, because not having looked is not a finding.
    """
    found = evidence.groupBy("source_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.when(F.col("matched"), F.struct("pos", "route")))),
            lambda r: r["route"],
        ).alias("routes")
    )
    return pending.join(found, "source_id").select(
        "identity_key",
        "source_id",
        F.when(F.size("routes") > 0, F.col("routes")).otherwise(F.array(F.lit(missing))).alias(
            "discovered_via"
        ),
    )
