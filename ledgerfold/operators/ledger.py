"""Reading, checking and appending the event ledger."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StructType

from ledgerfold.functions import text as tx
from ledgerfold.functions.jsonval import get_doc, get_strings, get_text, json_type, let, once, quote
from ledgerfold.functions.urls import safe_url
from ledgerfold.spec import (
    EVENT_DDL,
    EVENT_KEYS,
    EVENT_TYPES,
    EXTRACTION_METHODS,
    NOTICE_EVENT_TYPES,
    PROVENANCE_TYPE,
)

#: Files of one append to one folder, at most.
WRITERS = 4
#: The job that appends events, unless the caller names another.
ACTOR = "job"


def log_order() -> Column:
    """Observation order: time first, then place in the log."""
    return F.struct("observed_at", "seq")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of JSONL files as ``(path, line_no, line)``.

    Files are read in splits, so a long log is not one row of one task. A split
    keeps file order, so a line's number is its place in the split plus the lines
    of the splits before it.
    """
    raw = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_id"),
            F.col("value").alias("line"),
        )
    )
    blocks = raw.groupBy("path", "_block").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines")
    )
    before = W.partitionBy("path").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(
        "path", "_block", "_first", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_base")
    )
    return raw.join(blocks, ["path", "_block"]).select(
        "path",
        (F.col("_base") + F.col("_id") - F.col("_first") + 1).alias("line_no"),
        "line",
    )


def event_messages(line: Column, doc: Column) -> Column:
    """Why an event line is refused, as an array of messages (empty: accepted). ``doc`` is the line, parsed; names are read off the
    line, so the document is not written out again."""
    text = lambda path: get_text(doc, path)
    names = F.when(doc.isNotNull(), F.json_object_keys(line))
    entries = F.map_values(F.from_json(F.to_json(get_doc(doc, "$.provenance")), PROVENANCE_TYPE))
    parts = lambda names: F.struct(
        F.when(names.isNotNull(), "OBJECT").when(doc.isNotNull(), "other").alias("type"),
        F.array_except(names, F.array(*[F.lit(k) for k in EVENT_KEYS])).alias("unknown"),
        F.when(F.array_contains(names, "provenance"), entries).alias("entries"),
        text("$.event_type").alias("kind"),
        text("$.identity_key").alias("key"),
        text("$.observed_at").alias("at"),
    )
    blank = lambda c: F.coalesce(c, F.lit("")) == ""

    def judge(e: Column) -> Column:
        some = lambda test: F.exists(e["entries"], lambda p: F.coalesce(test(p), F.lit(False)))
        return F.array_compact(
            F.array(
                F.when(e["type"].isNull(), "not JSON"),
                F.when(e["type"] != "OBJECT", "not an object"),
                F.when(F.size(e["unknown"]) > 0,
                       F.concat(F.lit("unknown keys: "), F.array_join(e["unknown"], ", "))),
                F.when(~F.coalesce(e["kind"].isin(*EVENT_TYPES), F.lit(False)), "unknown event type"),
                F.when(e["key"].isNull(), "identity_key missing"),
                F.when(e["at"].isNull(), "observed_at missing"),
                F.when(some(lambda p: ~F.coalesce(p["extraction_method"].isin(*EXTRACTION_METHODS), F.lit(False))),
                       "unknown extraction method"),
                F.when(some(lambda p: (p["extraction_method"] == "llm")
                            & (blank(p["model"]) | blank(p["prompt_version"]))),
                       "model-inferred field without model and prompt version"),
                F.when(some(lambda p: (p["confidence"] < 0) | (p["confidence"] > 1)),
                       "confidence outside [0, 1]"),
            )
        )

    return let(let(names, parts), judge)


def parse_events(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(events, problems)`` from numbered lines; bad lines are reported, never raised.

    A file belongs to the identity on its first readable line; lines of any
    other identity are refused.
    """
    # One parse per line and pass, however often the document is asked and whatever is filtered by it.
    verdict = let(
        F.try_parse_json("line"),
        lambda d: F.struct(
            d.alias("doc"), event_messages(F.col("line"), d).alias("messages"), get_text(d, "$.identity_key").alias("key")
        ),
    )
    said = F.trim("line") != ""
    parsed = once(lines, verdict, said)
    named = once(lines, F.struct(F.try_parse_json("line").alias("d")), said).filter("d IS NOT NULL")
    owners = (
        named.select("path", "line_no", get_text(F.col("d"), "$.identity_key").alias("key"))
        .groupBy("path")
        .agg(F.min_by(F.struct("key"), "line_no").alias("_owner"))
        .select("path", F.col("_owner.key").alias("owner"))
    )
    # one row per file; rows are not counted first, since that would parse every line once more
    owned = parsed.join(owners, "path", "left")
    foreign = (F.size("messages") == 0) & (F.col("key") != F.col("owner"))
    problem = lambda reason, message: F.struct(
        F.lit("event_log_problem").alias("type"),
        F.element_at(F.split("path", "/"), -1).alias("path"),
        F.col("line_no").alias("line"),
        reason.alias("reason"),
        message.alias("message"),
    )
    refused = owned.filter((F.size("messages") > 0) | foreign).select(
        F.when(
            F.size("messages") > 0,
            problem(F.lit("malformed event line"), F.array_join("messages", "; ")),
        )
        .otherwise(
            problem(
                F.lit("event belongs to another identity"),
                F.concat(F.col("key"), F.lit(" in the log of "), F.col("owner")),
            )
        )
        .alias("p")
    ).select("p.*")
    stem = F.regexp_extract("path", r"([^/]+)\.jsonl$", 1)
    misnamed = owners.filter(
        F.col("owner").isNotNull()
        & ~stem.isin("")
        & (stem != tx.slug_for_identity(F.col("owner")))
        & (stem != tx.disambiguated_slug(F.col("owner")))
    ).select(
        F.lit("event_log_problem").alias("type"),
        F.element_at(F.split("path", "/"), -1).alias("path"),
        F.lit(1).cast("bigint").alias("line"),
        F.lit("file name does not match its identity").alias("reason"),
        F.concat(F.col("owner"), F.lit(" renders to "), tx.slug_for_identity(F.col("owner"))).alias(
            "message"
        ),
    )
    events = to_events(owned.filter((F.size("messages") == 0) & ~foreign))
    return events, refused.unionByName(misnamed).dropDuplicates()


def to_events(rows: DataFrame) -> DataFrame:
    """Typed event rows from ``(doc VARIANT, line_no)``."""
    doc = F.col("doc")
    obj = lambda name: F.coalesce(F.to_json(get_doc(doc, f"$.{name}")), F.lit("{}"))
    return rows.select(
        F.col("line_no").cast("bigint").alias("seq"),
        get_text(doc, "$.observed_at").alias("observed_at"),
        get_text(doc, "$.event_type").alias("event_type"),
        get_text(doc, "$.identity_key").alias("identity_key"),
        get_text(doc, "$.source_key").alias("source_key"),
        get_text(doc, "$.source_id").alias("source_id"),
        tx.blank_to_null(F.lower(tx.strip(get_text(doc, "$.source_system")))).alias("source_system"),
        obj("source").alias("source"),
        obj("local").alias("local"),
        F.coalesce(
            F.from_json(F.to_json(get_doc(doc, "$.provenance")), PROVENANCE_TYPE),
            F.create_map().cast(PROVENANCE_TYPE),
        ).alias("provenance"),
        get_strings(doc, "$.discovered_via").alias("discovered_via"),
        F.to_json(get_doc(doc, "$.notice")).alias("notice"),
        get_text(doc, "$.actor").alias("actor"),
        get_text(doc, "$.note").alias("note"),
    )


def read_ledger(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Events and problem rows of a folder of JSONL logs, one identity per file."""
    return parse_events(read_lines(spark, path))


def identities(events: DataFrame) -> DataFrame:
    """Every identity with its slug; order by ``slug`` where order matters."""
    return events.select("identity_key").distinct().withColumn(
        "slug", tx.slug_for_identity(F.col("identity_key"))
    )


def last_event(
    events: DataFrame, event_type: str | None = None, system: str | None = None
) -> DataFrame:
    """The newest matching event of every identity; the system matches in any case."""
    rows = events
    if event_type:
        rows = rows.filter(F.col("event_type") == event_type)
    if system:
        rows = rows.filter(F.col("source_system") == system.strip().lower())
    return (
        rows.groupBy("identity_key")
        .agg(F.max_by(F.struct(*rows.columns), log_order()).alias("e"))
        .select("e.*")
    )


def in_order(events: DataFrame) -> DataFrame:
    return events.orderBy("identity_key", "observed_at", "seq")


# -- writing -------------------------------------------------------------------


def sanitise_payload(payload: Column, task_field: str = "task") -> Column:
    """Safety rules for a ``source``/``local`` JSON object; absent keys stay absent.

    The ledger is the source of truth, so texts and lists are kept whole; the gate reports long ones.
    """
    fields = F.from_json(payload, "map<string,variant>")
    def clean(key: Column, value: Column) -> Column:
        """Value in a one-element JSON array, so that every branch is text."""
        strings = F.coalesce(
            F.try_variant_get(value, "$", "array<string>"), F.array().cast("array<string>")
        )
        safe_list = F.array_distinct(F.array_compact(F.transform(strings, lambda u: safe_url(u))))
        tasks = F.array_distinct(
            F.filter(F.transform(strings, tx.normalise_task), lambda t: t != "")
        )
        wrap = lambda arr: F.concat(F.lit("["), F.to_json(arr), F.lit("]"))
        variants = F.coalesce(
            F.try_variant_get(value, "$", "array<variant>"), F.array().cast("array<variant>")
        )
        url_of = lambda e: F.try_variant_get(e, "$.url", "string")
        links = F.filter(variants, lambda e: safe_url(url_of(e)).isNotNull())
        links = F.transform(links, lambda e: _replace_url(e, safe_url(url_of(e))))
        related = F.transform(
            F.filter(variants, lambda e: json_type(e) == "OBJECT"),
            lambda e: _replace_url(e, safe_url(url_of(e))),
        )
        wrap_docs = lambda arr: F.concat(F.lit("[["), F.array_join(arr, ","), F.lit("]]"))
        return (
            F.when(
                key == "url",
                F.when(F.to_json(value).isin("null", '""'),
                       F.concat(F.lit("["), F.to_json(value), F.lit("]")))
                .otherwise(F.coalesce(
                    F.to_json(F.array(safe_url(F.try_variant_get(value, "$", "string")))),
                    F.lit("[null]"))),
            )
            .when(key == "source_urls", wrap(safe_list))
            .when(key.isin("resources", "links"), wrap_docs(links))
            .when(key == "related_identifiers", wrap_docs(related))
            .when(key == task_field, wrap(tasks))
            .otherwise(F.concat(F.lit("["), F.to_json(value), F.lit("]")))
        )

    parts = F.transform(
        F.array_sort(F.map_entries(F.transform_values(fields, clean))),
        lambda e: F.concat(
            quote(e["key"]), F.lit(":"), e["value"].substr(F.lit(2), F.length(e["value"]) - 2)
        ),
    )
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))


def _replace_url(entry: Column, url: Column) -> Column:
    """An object's JSON with its ``url`` replaced, or left out when not linkable."""
    pairs = F.map_entries(F.from_json(F.to_json(entry), "map<string,variant>"))
    texts = F.transform(
        F.filter(pairs, lambda p: p["key"] != "url"),
        lambda p: F.struct(p["key"].alias("k"), F.to_json(p["value"]).alias("v")),
    )
    linked = F.when(
        url.isNotNull(), F.array(F.struct(F.lit("url").alias("k"), quote(url).alias("v")))
    ).otherwise(F.array().cast("array<struct<k:string,v:string>>"))
    merged = F.array_sort(F.concat(texts, linked))
    return F.concat(
        F.lit("{"),
        F.array_join(
            F.transform(merged, lambda p: F.concat(quote(p["k"]), F.lit(":"), p["v"])), ","
        ),
        F.lit("}"),
    )


def scrape_events(changed: DataFrame, observed_at: Column | None = None,
                  task_field: str = "task", actor: str = ACTOR) -> DataFrame:
    """Observations that changed, as ``scraped`` events with a sanitised payload.

    ``actor`` names the job; each event says which source it read.
    """
    rows = changed.withColumn("observed_at", observed_at) if observed_at is not None else changed
    return event_frame(
        rows.withColumn("event_type", F.lit("scraped"))
        .withColumn("source", sanitise_payload(F.col("source"), task_field))
        .withColumn("actor", F.concat(F.lit(f"{actor}/"), F.col("source_system")))
    )


def event_frame(rows: DataFrame) -> DataFrame:
    """Conform rows to the ledger schema; columns not given are empty."""
    schema = StructType.fromDDL(EVENT_DDL)
    blank = {"source": F.lit("{}"), "local": F.lit("{}")}
    return rows.select(
        *[
            (
                F.col(f.name)
                if f.name in rows.columns
                else blank.get(
                    f.name,
                    F.create_map() if f.name == "provenance"
                    else F.array() if f.name == "discovered_via" else F.lit(None),
                )
            )
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def with_seq(rows: DataFrame, order: list[str], first: int = 0) -> DataFrame:
    """Add ``seq`` rising with ``order`` from ``first``; unique, with gaps.

    The sort is range-partitioned and partitions number their own rows, so no task
    sees all rows.
    """
    return rows.orderBy(*order).withColumn(
        "seq", F.monotonically_increasing_id() + F.lit(first)
    )


def withdraw_events(rows: DataFrame, actor: str = ACTOR) -> DataFrame:
    """``(identity_key, source_system, observed_at, note)`` as ``withdrawn`` events."""
    return event_frame(
        rows.withColumn("event_type", F.lit("withdrawn")).withColumn(
            "actor",
            F.concat_ws("/", F.lit(actor), F.col("source_system")),
        )
    )


def notice_events(rows: DataFrame) -> DataFrame:
    """``(identity_key, event_type, notice, observed_at, note)`` as notice events."""
    known = F.col("event_type").isin(*NOTICE_EVENT_TYPES)
    return event_frame(
        rows.withColumn(
            "event_type",
            F.when(F.assert_true(known, F.lit("not a notice event type")).isNull(), F.col("event_type")),
        ).withColumn("actor", F.lit("reconcile"))
    )


BUCKETS = 256
#: DDL of the stored ledger.
TABLE_DDL = EVENT_DDL + ", ingest string, bucket int"


def bucket_of(key: Column | str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def append_events(events: DataFrame, path: str, ingest: str, buckets: int = BUCKETS) -> None:
    """The only write path. Events land by type and identity bucket, so folds prune by
    type and incremental rebuilds read few buckets.

    An append is named by ``ingest``; writing it again replaces itself and nothing
    else, so a retried run or micro-batch cannot append twice. ``seq`` must be set and
    the key columns filled.
    """
    complete = (
        F.col("identity_key").isNotNull() & F.col("seq").isNotNull() & F.col("observed_at").isNotNull()
        & F.col("event_type").isin(*EVENT_TYPES)
    )
    refused = F.assert_true(complete, F.lit("an event needs identity_key, seq, observed_at and a known type"))
    checked = events.withColumn(
        "identity_key", F.when(refused.isNull(), F.col("identity_key"))
    ).withColumn("bucket", bucket_of("identity_key", buckets))
    # one file per folder and salt, not one per task and folder; a hot bucket keeps several writers
    salt = F.pmod(F.xxhash64("identity_key", "seq"), F.lit(WRITERS))
    placed = checked.repartition("event_type", "bucket", salt)
    placed.write.mode("overwrite").partitionBy("event_type", "bucket").parquet(f"{path}/ingest={ingest}")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The ledger written by :func:`append_events`; no ledger yet reads as empty."""
    try:
        return spark.read.schema(TABLE_DDL).option("basePath", path).parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], TABLE_DDL)


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the events that :func:`append_events` writes to this ledger, read from its own files."""
    return spark.readStream.schema(TABLE_DDL).option("basePath", path).parquet(path)
