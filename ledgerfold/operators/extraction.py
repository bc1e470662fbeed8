"""The extraction cache and its pending queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.functions import text as tx
from ledgerfold.functions.jsonval import canonical

CACHE_DDL = (
    "key string, model string, prompt_version string, content_sha256 string, extracted_at string, "
    "fields string, confidence map<string,double>, pinned boolean, pin_source_key string, pin_url string"
)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """Cache entries; one without key, model or prompt version is a miss, not an error."""
    rows = spark.read.schema(CACHE_DDL).option("mode", "PERMISSIVE").json(path, multiLine=True)
    return valid_entries(rows)


def valid_entries(rows: DataFrame) -> DataFrame:
    return rows.filter(
        F.col("key").isNotNull() & F.col("model").isNotNull() & F.col("prompt_version").isNotNull()
    )


def upsert_cache(cache: DataFrame, fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(next cache, changed entries)``; an entry equal to the stored one is no change."""
    digest = lambda d: d.withColumn(
        "_digest", F.sha2(F.concat_ws("\x1f", "model", "prompt_version", "content_sha256",
                                      canonical(F.col("fields")), "pinned", "pin_source_key", "pin_url"), 256)
    )
    stored = digest(cache).select("key", F.col("_digest").alias("_stored"))
    judged = digest(fresh).join(stored, "key", "left")
    changed = judged.filter(~F.col("_digest").eqNullSafe(F.col("_stored"))).drop("_digest", "_stored")
    kept = cache.join(changed.select("key"), "key", "left_anti")
    return kept.unionByName(changed), changed


def lookup_cache(
    pages: DataFrame, cache: DataFrame, prompt_version: str, lineage: list[str]
) -> DataFrame:
    """Each page ``(url, content)`` with its cache entry.

    The keys of every model lineage are tried, the first of the list first; a page
    whose content misses is served the entry pinned to its address. ``pin_held`` says
    a pin is served for content it was not made against. ``primary_key`` is what a
    fresh extraction would be stored under.
    """
    rows = pages.withColumn("content_hash", tx.content_hash(F.col("content")))
    tried = rows.select(
        "url",
        F.posexplode(
            F.array(*[tx.cache_key(F.col("content"), F.lit(prompt_version), F.lit(m)) for m in lineage])
        ).alias("pos", "key"),
    )
    entry = F.struct(*[c for c in cache.columns])
    hits = (
        tried.join(cache.select("key", entry.alias("entry")), "key")
        .groupBy("url").agg(F.min_by("entry", "pos").alias("hit"))
    )
    pins = (
        cache.filter("pinned").filter(F.coalesce("pin_url", F.lit("")) != "")
        .groupBy(F.col("pin_url").alias("url")).agg(F.max_by(entry, "key").alias("pin"))
    )
    found = rows.join(hits, "url", "left").join(pins, "url", "left").withColumn(
        "served", F.coalesce("hit", "pin")
    )
    return found.select(
        "url",
        tx.cache_key(F.col("content"), F.lit(prompt_version), F.lit(lineage[0])).alias("primary_key"),
        F.col("served.key").alias("key"),
        F.col("served.model").alias("model"),
        F.col("served.fields").alias("fields"),
        F.col("served").isNotNull().alias("hit"),
        (
            F.coalesce("served.pinned", F.lit(False))
            & (F.coalesce("served.pin_source_key", F.lit("")) != "")
            & (F.col("served.pin_source_key") != F.col("content_hash"))
        ).alias("pin_held"),
    )


def upsert_queue(queued: DataFrame) -> DataFrame:
    """The queue with one row per key: first sighting kept, newest reason wins.

    ``queued`` is ``(seq, url, cache_key, reason, queued_at)``, old rows and new; ``reason_seq``, where there is one, is the place of the
    reason and is kept, so that one which comes late doesn't displace a newer one.
    """
    placed = "reason_seq" in queued.columns
    at = "reason_seq" if placed else "seq"
    return queued.groupBy("cache_key").agg(
        F.min_by("url", "seq").alias("url"),
        F.max_by("reason", at).alias("reason"),
        F.min("queued_at").alias("queued_at"),
        F.min("seq").alias("queue_pos"),
        *([F.max(at).alias(at)] if placed else []),
    )


def drain_queue(queue: DataFrame, limit: int, order: str = "queue_pos") -> DataFrame:
    """The next entries within a budget, first in first out."""
    return queue.orderBy(order).limit(limit)


def remaining_queue(queue: DataFrame, resolved: DataFrame) -> DataFrame:
    return queue.join(resolved.select("cache_key").distinct(), "cache_key", "left_anti")


def drop_invented(records: Column, allowed: Column) -> Column:
    """Blank the identifier of extracted records when it was not among those supplied.

    ``records`` is an array of structs with a ``doi`` field.
    """
    known = F.transform(allowed, lambda d: F.lower(tx.strip(d)))
    return F.transform(
        records,
        lambda r: r.withField(
            "doi", F.when(F.array_contains(known, F.lower(tx.strip(r["doi"]))), r["doi"])
        ),
    )
