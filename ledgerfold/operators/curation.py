"""Curator annotations, pins and withdrawals planned as new events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.functions import text as tx
from ledgerfold.functions.jsonval import (
    get_doc,
    get_text,
    json_object,
    json_type,
    quote,
    text_of,
)
from ledgerfold.operators.ledger import event_frame, sanitise_payload
from ledgerfold.operators.reconcile import canonical_group
from ledgerfold.spec import ACCESS_STATUSES, PROVENANCE_TYPE, RESOURCE_KINDS

# The fields a curator may set.
CURATOR_FIELDS = (
    "access_status", "curator_notes", "links", "owner_org", "pin_source_key", "pinned",
    "resource_kind", "source_urls", "suppressed", "task",
)
DEFAULT_ACTOR = "curator"


def fingerprint(key: Column, local: Column, actor: Column, note: Column) -> Column:
    """Identity of an annotation, whenever it was applied. ``local`` is canonical JSON."""
    payload = json_object(
        [
            ("identity_key", quote(key)),
            ("actor", quote(F.coalesce(tx.blank_to_null(actor), F.lit(DEFAULT_ACTOR)))),
            ("note", quote(F.coalesce(note, F.lit("")))),
            ("local", F.coalesce(local, F.lit("{}"))),
        ]
    )
    return F.substring(F.sha2(payload, 256), 1, 16)


def read_annotations(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Annotation documents (one JSON document per file) as rows, and the rejects.

    A document is ``{identity_key, actor?, allow_new?, annotations: [{local, note?,
    actor?, observed_at?, allow_new?}]}``. A bad file is one reject; the rest apply.
    """
    # files are told apart by their place below the folder, so equal names in two subfolders stay two
    root = path.rstrip("/").rsplit("/", 1)[-1]
    below = F.replace(F.substring_index("_metadata.file_path", f"/{root}/", -1), F.lit("file:"), F.lit(""))
    files = spark.read.text(path, wholetext=True).select(
        below.alias("path"),
        F.try_parse_json("value").alias("doc"),
    )
    return parse_annotations(files)


def parse_annotations(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    doc = F.col("doc")
    entries = F.try_variant_get(doc, "$.annotations", "array<variant>")
    local = lambda e: get_doc(e, "$.local")
    fields = lambda e: F.map_keys(F.from_json(F.to_json(local(e)), "map<string,variant>"))
    allowed = F.array(*[F.lit(f) for f in CURATOR_FIELDS])
    has = lambda d, name: get_doc(d, f"$.{name}").isNotNull()
    bad_entry = lambda e: (
        F.when(json_type(e) != "OBJECT", "must be a mapping")
        .when(has(e, "source"), "annotations may not set 'source'")
        .when(local(e).isNull() | (json_type(local(e)) != "OBJECT") | (F.size(fields(e)) == 0),
              "'local' must be a non-empty mapping")
        .when(F.size(F.array_except(fields(e), allowed)) > 0,
              F.concat(F.lit("annotations may not set "),
                       F.array_join(F.array_sort(F.array_except(fields(e), allowed)), ", ")))
    )
    entry_errors = F.array_compact(
        F.transform(
            F.coalesce(entries, F.array().cast("array<variant>")),
            lambda e, i: F.when(
                bad_entry(e).isNotNull(),
                F.concat(F.lit("annotations["), i.cast("string"), F.lit("]: "), bad_entry(e)),
            ),
        )
    )
    error = (
        F.when(doc.isNull() | (json_type(doc) != "OBJECT"), "top level must be a mapping")
        .when(has(doc, "source"), "annotations may not set 'source'")
        .when(F.coalesce(tx.strip(get_text(doc, "$.identity_key")), F.lit("")) == "",
              "'identity_key' is required")
        .when(entries.isNull() | (F.size(entries) == 0), "'annotations' must be a non-empty list")
        .when(F.size(entry_errors) > 0, F.get(entry_errors, F.lit(0)))
    )
    judged = files.withColumn("error", error)
    rejects = judged.filter(F.col("error").isNotNull()).select(
        "path", F.concat(F.col("path"), F.lit(": "), F.col("error")).alias("message")
    )
    rows = judged.filter(F.col("error").isNull()).select(
        "path", "doc", F.posexplode(entries).alias("entry_pos", "entry")
    )
    entry = F.col("entry")
    annotations = rows.select(
        tx.strip(get_text(doc, "$.identity_key")).alias("identity_key"),
        F.struct("path", "entry_pos").alias("pos"),
        sanitise_payload(F.to_json(local(entry))).alias("local"),
        F.coalesce(tx.blank_to_null(get_text(entry, "$.actor")),
                   tx.blank_to_null(get_text(doc, "$.actor")), F.lit(DEFAULT_ACTOR)).alias("actor"),
        get_text(entry, "$.note").alias("note"),
        get_text(entry, "$.observed_at").alias("observed_at"),
        F.coalesce(
            F.try_variant_get(entry, "$.allow_new", "boolean"),
            F.try_variant_get(doc, "$.allow_new", "boolean"),
            F.lit(False),
        ).alias("allow_new"),
        "path",
    )
    return annotations, rejects


def check_annotations(
    annotations: DataFrame, organisations: DataFrame, groups: DataFrame, task_field: str = "task"
) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejects)`` against the registers: owners and tasks must be known."""
    rows = annotations.withColumn("_row", F.struct("path", "pos"))
    doc = F.try_parse_json("local")
    owners = rows.select("_row", get_text(doc, "$.owner_org").alias("name")).filter(
        F.col("name").isNotNull()
    )
    bad_owner = owners.join(organisations.select("name"), "name", "left_anti").select(
        "_row", F.concat(F.lit("owner_org "), F.col("name"), F.lit(" is not registered")).alias("error")
    )
    tasks = rows.select(
        "_row", F.explode(F.try_variant_get(doc, f"$.{task_field}", "array<string>")).alias("value")
    )
    bad_task = (
        canonical_group(F.col("value"), groups, tasks, "task")
        .join(groups.select(F.col("name").alias("task")), "task", "left_anti")
        .select("_row", F.concat(F.lit("task "), F.col("value"), F.lit(" is not registered")).alias("error"))
    )
    values = rows.select(
        "_row",
        F.when(~F.coalesce(get_text(doc, "$.resource_kind").isin(*RESOURCE_KINDS), F.lit(True)),
               "unknown resource_kind")
        .when(~F.coalesce(get_text(doc, "$.access_status").isin(*ACCESS_STATUSES), F.lit(True)),
              "unknown access_status").alias("error"),
    ).filter(F.col("error").isNotNull())
    errors = bad_owner.unionByName(bad_task).unionByName(values).groupBy("_row").agg(
        F.min("error").alias("error")
    )
    judged = rows.join(errors, "_row", "left")
    rejects = judged.filter(F.col("error").isNotNull()).select(
        "identity_key", "pos", F.concat_ws(": ", "path", "error").alias("message")
    )
    return judged.filter(F.col("error").isNull()).drop("_row", "error"), rejects


def plan_annotations(annotations: DataFrame, known: DataFrame, recorded: DataFrame) -> DataFrame:
    """Each annotation with ``outcome``: applied, skipped or pending.

    ``annotations`` holds ``(identity_key, pos, fingerprint, allow_new)``; ``known``
    the identities of the ledger; ``recorded`` the ``(identity_key, fingerprint)``
    already in it. A row waits while its identity is unknown, unless it or an
    earlier row of the batch may create it. Of equal rows the first is applied.
    """
    rows = annotations.join(
        recorded.select("identity_key", "fingerprint").distinct().withColumn("recorded", F.lit(True)),
        ["identity_key", "fingerprint"],
        "left",
    ).join(
        known.select("identity_key").distinct().withColumn("known", F.lit(True)), "identity_key", "left"
    )
    fresh = rows.filter(F.col("recorded").isNull())
    opened = fresh.filter("allow_new").groupBy("identity_key").agg(F.min("pos").alias("opened_at"))
    rows = rows.join(opened, "identity_key", "left").withColumn(
        "eligible", F.col("known").isNotNull() | F.coalesce(F.col("pos") >= F.col("opened_at"), F.lit(False))
    )
    first = (
        rows.filter(F.col("eligible") & F.col("recorded").isNull())
        .groupBy("identity_key", "fingerprint")
        .agg(F.min("pos").alias("first_pos"))
    )
    judged = rows.join(first, ["identity_key", "fingerprint"], "left")
    outcome = (
        F.when(F.col("recorded").isNotNull(), "skipped")
        .when(~F.col("eligible"), "pending")
        .when(F.col("pos") == F.col("first_pos"), "applied")
        .otherwise("skipped")
    )
    return judged.withColumn("outcome", outcome).select(*annotations.columns, "outcome")


def recorded_fingerprints(events: DataFrame) -> DataFrame:
    rows = events.filter(F.col("event_type") == "annotated")
    return rows.select(
        "identity_key",
        fingerprint(F.col("identity_key"), F.col("local"), F.col("actor"), F.col("note")).alias("fingerprint"),
    )


def curator_provenance(local: Column) -> Column:
    """One ``curator`` entry per field a JSON object sets."""
    keys = F.map_keys(F.from_json(local, "map<string,variant>"))
    entry = F.from_json(
        F.lit('{"extraction_method":"curator"}'),
        "extraction_method string, model string, prompt_version string, confidence double, "
        "source_system string, pinned boolean",
    )
    return F.map_from_arrays(keys, F.transform(keys, lambda _: entry)).cast(PROVENANCE_TYPE)


def annotation_events(applied: DataFrame, now: Column) -> DataFrame:
    return event_frame(
        applied.withColumn("event_type", F.lit("annotated"))
        .withColumn("observed_at", F.coalesce("observed_at", now))
        .withColumn("provenance", curator_provenance(F.col("local")))
    )


def annotation_notices(planned: DataFrame, rejects: DataFrame) -> DataFrame:
    """Errors and waiting annotations, for the run report."""
    none = F.lit(None).cast("string")
    return rejects.select(
        F.lit("annotation_error").alias("type"), none.alias("identity_key"), none.alias("source"), "message"
    ).unionByName(
        planned.filter(F.col("outcome") == "pending").select(
            F.lit("annotation_pending").alias("type"),
            "identity_key",
            F.col("path").alias("source"),
            F.lit("annotation waits for the record to be harvested; it will apply itself on the run "
                  "that first sees this identity").alias("message"),
        )
    )


def annotated_fields(annotations: DataFrame) -> DataFrame:
    """Every field a batch of annotations touches."""
    return annotations.select(
        F.explode(F.map_keys(F.from_json("local", "map<string,variant>"))).alias("field")
    ).distinct()


def pin_conflicts(state: DataFrame, stated: DataFrame) -> DataFrame:
    """Pins whose page moved: one row per identity and observed token.

    ``state`` is ``(identity_key, pinned, pin_source_key, source_key, ...)`` and
    ``stated`` the ``(identity_key, observed_source_key)`` already noticed.
    """
    moved = state.filter(
        F.col("pinned") & (F.coalesce("pin_source_key", F.lit("")) != "")
        & (F.coalesce("source_key", F.lit("")) != "")
        & (F.col("source_key") != F.col("pin_source_key"))
    )
    told = stated.select("identity_key", F.col("observed_source_key").alias("source_key")).distinct()
    return moved.join(told, ["identity_key", "source_key"], "left_anti")


def pin_notices(resolved: DataFrame, events: DataFrame) -> DataFrame:
    """``pin_notice`` events, stamped with the time of the scrape that moved the page."""
    local = F.col("local")
    last = (
        events.filter(F.col("event_type") == "scraped")
        .groupBy("identity_key")
        .agg(F.max("observed_at").alias("observed_at"))
    )
    state = resolved.select(
        "identity_key", "source_key", "source_system",
        (F.coalesce(F.element_at(local, "pinned"), F.lit("")) == "true").alias("pinned"),
        text_of(F.element_at(local, "pin_source_key")).alias("pin_source_key"),
    )
    stated = events.filter(F.col("event_type") == "pin_notice").select(
        "identity_key",
        get_text(F.try_parse_json("notice"), "$.observed_source_key").alias("observed_source_key"),
    )
    rows = pin_conflicts(state, stated).join(last, "identity_key")
    notice = json_object(
        [
            ("reason", F.lit('"page-content-hash-changed"')),
            ("pin_source_key", quote(F.col("pin_source_key"))),
            ("observed_source_key", quote(F.col("source_key"))),
            ("source_system", quote(F.col("source_system"))),
            ("action", F.lit('"the pin holds; a human decides whether it is still right"')),
        ]
    )
    return event_frame(
        rows.select(
            "identity_key",
            F.lit("pin_notice").alias("event_type"),
            "observed_at",
            notice.alias("notice"),
            F.lit("reconcile").alias("actor"),
            F.concat(F.lit("the page moved beneath a pinned extraction ("), F.col("pin_source_key"),
                     F.lit(" -> "), F.col("source_key"), F.lit(")")).alias("note"),
        )
    )


def is_tombstone(payload: Column) -> Column:
    """Whether a payload says its record was removed."""
    status = get_doc(payload, "$.status")
    number = F.when(json_type(status).isin("BIGINT", "INT", "SMALLINT", "TINYINT"),
                    F.try_variant_get(status, "$", "bigint"))
    deletion = get_doc(payload, "$.deletion_status")
    truthy = lambda doc: doc.isNotNull() & ~F.to_json(doc).isin("null", "false", "{}", "[]", '""', "0")
    hit = (
        truthy(get_doc(payload, "$.tombstone"))
        | (F.to_json(get_doc(payload, "$.is_deleted")) == "true")
        | truthy(get_doc(payload, "$.deletion_status.is_deleted"))
        | F.upper(F.when(json_type(deletion) == "STRING", F.try_variant_get(deletion, "$", "string"))).isin("D", "P", "X")
        | number.isin(404, 410)
        | F.lower(tx.strip(F.when(json_type(status) == "STRING", F.try_variant_get(status, "$", "string")))).isin("removed", "deleted")
    )
    return F.coalesce(truthy(get_doc(payload, "$.tombstone")), F.lit(False)) | F.coalesce(hit, F.lit(False))


def tombstone_note(payload: Column, source: str = "Zenodo") -> Column:
    reason = F.coalesce(
        get_text(payload, "$.tombstone.removal_reason.id"),
        F.when(json_type(get_doc(payload, "$.tombstone.removal_reason")) == "STRING",
               get_text(payload, "$.tombstone.removal_reason")),
    )
    return F.concat_ws(
        "; ",
        F.lit(f"record removed at {source}"),
        F.concat(F.lit("reason: "), tx.blank_to_null(reason)),
        tx.blank_to_null(get_text(payload, "$.tombstone.note")),
        F.concat(F.lit("removed "), tx.blank_to_null(get_text(payload, "$.tombstone.removal_date"))),
    )


def withdrawals_from_tombstones(statuses: DataFrame, events: DataFrame) -> DataFrame:
    """``withdrawn`` rows for re-checked records that are gone, once per identity.

    ``statuses`` is ``(identity_key, source_system, status_code, payload, observed_at)``.
    An unreadable body counts as its status code.
    """
    doc = F.coalesce(
        F.try_parse_json("payload"),
        F.try_parse_json(F.concat(F.lit('{"status":'), F.col("status_code"), F.lit("}"))),
    )
    gone = statuses.filter(F.col("status_code").isin(404, 410)).withColumn("doc", doc).filter(
        is_tombstone(F.col("doc"))
    )
    told = events.filter(F.col("event_type") == "withdrawn").select("identity_key").distinct()
    return (
        gone.join(told, "identity_key", "left_anti")
        .groupBy("identity_key", "source_system")
        .agg(F.min("observed_at").alias("observed_at"), F.min(tombstone_note(F.col("doc"))).alias("note"))
    )
