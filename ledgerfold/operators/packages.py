"""Shaping resolved records into published packages, and writing what changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions import text as tx
from ledgerfold.functions.jsonval import get_strings, is_empty, text_of
from ledgerfold.operators.classify import derive_type
from ledgerfold.operators.graph import decide_scope
from ledgerfold.operators.licences import map_licences
from ledgerfold.operators.organisations import infer_owner
from ledgerfold.operators.reconcile import canonical_group
from ledgerfold.operators.skew import per_key_join
from ledgerfold.sources.registers import LICENCE_IDS, licence_aliases
from ledgerfold.spec import LedgerSpec


def lifecycle(withdrawn: Column, archived: Column) -> Column:
    return F.when(withdrawn, "withdrawn").when(archived, "archived").otherwise("active")


def build_extras(entries: dict[str, Column]) -> Column:
    """``ARRAY<STRUCT<key, value>>`` in key order from text columns; NULL and ``[]``
    are left out, while the empty string, ``false`` and ``{}`` are kept."""
    pairs = [
        F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))
        for key, value in sorted(entries.items())
    ]
    return F.filter(F.array(*pairs), lambda e: e["value"].isNotNull() & (e["value"] != "[]"))


def allocate_slugs(firsts: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """``(identity_key, slug)``: the earliest identity keeps the plain slug.

    ``firsts`` is ``(identity_key, first_seq)``. Identities already in the insert-only
    ``registry`` (identity_key, slug) keep what they have, so no address ever moves;
    a taken plain slug gives the newcomer its digest form.
    """
    key = F.col("identity_key")
    rows = firsts.withColumn("plain", tx.slug_for_identity(key))
    if registry is not None:
        kept = registry.select("identity_key", F.col("slug").alias("held"))
        rows = rows.join(kept, "identity_key", "left")
        taken = registry.select(F.col("slug").alias("plain"), F.lit(True).alias("taken")).distinct()
        rows = rows.join(taken, "plain", "left")
    else:
        rows = rows.withColumns({"held": F.lit(None).cast("string"), "taken": F.lit(None).cast("boolean")})
    owners = rows.groupBy("plain").agg(
        F.min_by("identity_key", F.struct("first_seq", "identity_key")).alias("owner"),
        F.count(F.lit(1)).alias("rows"),
    )
    placed = per_key_join(rows, owners, ["plain"])
    first = (key == F.col("owner")) & F.col("taken").isNull()
    return placed.select(
        "identity_key",
        F.coalesce("held", F.when(first, F.col("plain")).otherwise(tx.disambiguated_slug(key))).alias("slug"),
    )


def slug_collisions(packages: DataFrame) -> DataFrame:
    """``(name, identities)`` for names more than one identity renders to."""
    return (
        packages.select("name", "identity_key").distinct()
        .groupBy("name").agg(F.count(F.lit(1)).alias("identities"))
        .filter(F.col("identities") > 1)
    )


def build_packages(
    resolved: DataFrame,
    scope: DataFrame,
    slugs: DataFrame,
    organisations: DataFrame,
    groups: DataFrame,
    spec: LedgerSpec | None = None,
    programme: str | None = None,
    phrases: dict[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(packages, notices)``: one published record per identity."""
    spec = spec or LedgerSpec()
    spark = resolved.sparkSession
    task = spec.task_field
    eff = F.col("effective")
    raw = lambda f: F.element_at(eff, f)
    value = lambda f: text_of(raw(f))
    listed = lambda f: F.when(~is_empty(raw(f)) & (raw(f) != "false"), raw(f))

    rows = (
        resolved.join(scope, "identity_key").join(slugs, "identity_key")
        .join(infer_owner(resolved, organisations).drop("basis"), "identity_key")
    )
    # Registered tasks: canonical, distinct and sorted; unknown names stay in the extras.
    named = resolved.select(
        "identity_key", F.explode(get_strings(F.try_parse_json(raw(task)), "$")).alias("value")
    ).filter(F.col("value") != "")
    known = groups.select(F.col("name").alias("group"), F.lit(True).alias("known"))
    tasks = (
        canonical_group(F.col("value"), groups, named, "group")
        .select("identity_key", "group").distinct()
        .join(known, "group", "left")
    )
    notices = tasks.filter(F.col("known").isNull()).select(
        F.lit("unknown_group").alias("type"), "identity_key", "group",
        F.concat(F.lit("task "), F.col("group"), F.lit(
            " is not registered; the group was dropped from the record (the attribution is kept "
            "in the extras and in the event log)")).alias("message"),
    )
    per_record = tasks.groupBy("identity_key").agg(
        F.array_sort(F.collect_list("group")).alias("task_names"),
        F.array_sort(F.collect_list(F.when(F.col("known"), F.col("group")))).alias("group_names"),
    )
    rows = rows.join(per_record, "identity_key", "left")
    aliases = licence_aliases(spark)
    rows = rows.withColumn("_raw", value("license_raw")).withColumn("_id", value("license_id"))
    rows = map_licences(rows, "_raw", aliases, "_raw_id", "_raw_mapped")
    rows = rows.withColumn("_text", F.coalesce(tx.blank_to_null(F.col("_id")), F.col("_raw")))
    rows = map_licences(rows, "_text", aliases, "_text_id", "_text_mapped")
    licence = F.when(F.col("_id").isin(*LICENCE_IDS), F.col("_id")).otherwise(F.col("_text_id"))

    urls = get_strings(F.try_parse_json(raw("source_urls")), "$")
    own = tx.blank_to_null(value("url"))
    all_urls = F.when(own.isNotNull() & ~F.array_contains(urls, own), F.concat(F.array(own), urls)).otherwise(urls)
    rows = rows.withColumn("_urls", all_urls).withColumn(
        "_type", derive_type(eff, F.col("source_systems"), F.col("inclusion_basis"), programme, task, phrases)
    )
    kind, rtype, method = F.col("_type.kind"), F.col("_type.type"), F.col("_type.method")

    entry = F.col("provenance").getItem("resource_kind")
    blank = F.from_json(
        F.concat(F.lit('{"extraction_method":"'), method, F.lit('"}')),
        "extraction_method string, model string, prompt_version string, confidence double, "
        "source_system string, pinned boolean",
    )
    type_entry = F.when(rtype.isNotNull(), F.when(method.isNotNull(), blank).otherwise(entry))
    merged = F.map_from_entries(
        F.concat(
            F.filter(F.map_entries(F.coalesce("provenance", F.create_map().cast(
                "map<string,struct<extraction_method:string,model:string,prompt_version:string,"
                "confidence:double,source_system:string,pinned:boolean>>"))),
                lambda e: (e["key"] != "resource_type") | type_entry.isNull()),
            F.when(type_entry.isNotNull(), F.array(F.struct(F.lit("resource_type").alias("key"),
                                                            type_entry.alias("value"))))
            .otherwise(F.array().cast("array<struct<key:string,value:struct<extraction_method:string,"
                                      "model:string,prompt_version:string,confidence:double,"
                                      "source_system:string,pinned:boolean>>>")),
        )
    )
    provenance = F.when(F.size(merged) > 0, F.to_json(F.to_variant_object(
        F.transform_values(merged, lambda _, p: F.from_json(F.to_json(p), "map<string,variant>")))))
    flag = lambda f: F.when(F.coalesce(F.element_at("local", f), F.lit("null")).isin("null", "false", '""', "[]", "{}", "0"), None).otherwise("true")
    local_list = lambda f: F.when(~is_empty(F.element_at("local", f)), F.element_at("local", f))

    extras = build_extras(
        {
            "identity_key": F.col("identity_key"),
            "identity_kind": tx.identity_kind(F.col("identity_key")),
            "source_system": F.col("source_system"),
            "source_systems": F.when(F.size("source_systems") > 0, F.to_json("source_systems")),
            "source_id": F.col("source_id"),
            "source_key": F.col("source_key"),
            "source_url": F.get(F.col("_urls"), F.lit(0)),
            "source_urls": F.when(F.size("_urls") > 0, F.to_json("_urls")),
            "doi": value("doi"),
            task: F.when(F.size("task_names") > 0, F.to_json("task_names")),
            "resource_kind": kind,
            "resource_type": rtype,
            "inclusion_basis": F.col("inclusion_basis"),
            "inclusion_evidence": tx.blank_to_null(F.col("inclusion_evidence")),
            "access_status": value("access_status"),
            "embargo_date": value("embargo_date"),
            "authors": listed("authors"),
            "publisher": value("publisher"),
            "published_date": value("published_date"),
            "container": value("container"),
            "report_number": value("report_number"),
            "related_identifiers": listed("related_identifiers"),
            "license_raw": F.col("_raw"),
            "license_mapped": F.when(F.col("_raw").isNotNull(), F.col("_raw_mapped").cast("string")),
            "curator_notes": local_list("curator_notes"),
            "local_links": local_list("links"),
            "provenance": provenance,
            "lifecycle_state": lifecycle(F.col("withdrawn"), F.coalesce(raw("archived") == "true", F.lit(False))),
            "withdrawn": F.col("withdrawn").cast("string"),
            "withdrawn_at": F.col("withdrawn_at"),
            "first_seen": F.col("first_seen"),
            "last_seen": F.col("last_seen"),
            "suppressed": flag("suppressed"),
            "pinned": flag("pinned"),
        }
    )
    keywords = get_strings(F.try_parse_json(raw("keywords")), "$")
    tags = F.array_sort(F.array_distinct(F.filter(F.transform(keywords, tx.tagify), lambda t: t != "")))
    links = F.try_variant_get(
        F.try_parse_json(raw("resources")), "$",
        "array<struct<url:string,name:string,description:string,format:string>>",
    )
    packages = rows.select(
        "identity_key",
        F.col("slug").alias("name"),
        F.coalesce(tx.blank_to_null(tx.strip(value("title"))), F.col("identity_key")).alias("title"),
        F.coalesce(value("notes"), F.lit("")).alias("notes"),
        licence.alias("license_id"),
        F.transform(tags, lambda t: F.struct(t.alias("name"))).alias("tags"),
        extras.alias("extras"),
        F.filter(
            F.coalesce(links, F.array().cast("array<struct<url:string,name:string,description:string,format:string>>")),
            lambda r: F.coalesce(r["url"], F.lit("")) != "",
        ).alias("resources"),
        F.transform(
            F.coalesce("group_names", F.array().cast("array<string>")), lambda g: F.struct(g.alias("name"))
        ).alias("groups"),
        "owner_org",
        tx.blank_to_null(value("url")).alias("url"),
        tx.blank_to_null(value("version")).alias("version"),
        F.lit("active").alias("state"),
        F.lit(False).alias("private"),
    )
    return packages, notices


def extra(key: str) -> Column:
    """A package extra by key; the empty string counts as absent."""
    hit = F.filter("extras", lambda e: e["key"] == key)
    return tx.blank_to_null(F.get(hit, F.lit(0))["value"])


def extra_list(key: str) -> Column:
    """A package extra holding a JSON list of strings; anything else is empty."""
    return get_strings(F.try_parse_json(extra(key)), "$")


def unmapped_licences(packages: DataFrame) -> DataFrame:
    """Records whose stated licence no register id fits."""
    return packages.filter(extra("license_mapped") == "false").select(
        extra("identity_key").alias("identity_key"), "name",
        F.coalesce(extra("license_raw"), F.lit("")).alias("license_raw"),
    )


def record_json(packages: DataFrame) -> Column:
    """A package as canonical JSON: sorted keys, no NULL properties."""
    cols = sorted(c for c in packages.columns if c != "identity_key")
    return F.to_json(F.try_parse_json(F.to_json(F.struct(*cols))))


def publish_diff(new: DataFrame, old: DataFrame, key: str = "name") -> DataFrame:
    """``(key, action)``: written, unchanged or pruned, from content digests.

    Both sides are ``(key, digest)``. A withdrawn record keeps its events and so is
    on the new side; only a record with no events is pruned.
    """
    a = new.select(key, F.col("digest").alias("_new"))
    b = old.select(key, F.col("digest").alias("_old"))
    action = (
        F.when(F.col("_new").isNull(), "pruned")
        .when(F.col("_new").eqNullSafe(F.col("_old")), "unchanged")
        .otherwise("written")
    )
    return a.join(b, key, "full_outer").select(key, action.alias("action"))


def digests(packages: DataFrame) -> DataFrame:
    return packages.select("name", F.sha2(record_json(packages), 256).alias("digest"))


def read_records(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """``(records, violations)`` from files of one JSON record each."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"),
        F.regexp_extract("_metadata.file_path", r"([^/]+)\.json$", 1).alias("stem"),
        F.try_parse_json("value").alias("doc"),
    )
    bad = F.col("doc").isNull() | ~F.schema_of_variant("doc").startswith("OBJECT")
    violations = files.filter(F.coalesce(bad, F.lit(True))).select(
        F.concat("stem", F.lit(".json")).alias("record"), F.lit("<file>").alias("field"),
        F.when(F.col("doc").isNull(), "invalid JSON").otherwise("top level must be an object").alias("message"),
        "path",
    )
    return files.filter(~F.coalesce(bad, F.lit(True))), violations


def replay(
    events: DataFrame, key: str, organisations: DataFrame, groups: DataFrame,
    generic_routes: list[str], spec: LedgerSpec | None = None, programme: str | None = None, phrases: dict[str, str] | None = None,
) -> DataFrame:
    """The package of one identity from its own events; scope knows the direct limb only."""
    from ledgerfold.operators.resolve import resolve

    spec = spec or LedgerSpec()
    resolved = resolve(events.filter(F.col("identity_key") == key), spec)
    scope = decide_scope(resolved, None, generic_routes, spec.task_field)
    slugs = resolved.select("identity_key", tx.slug_for_identity(F.col("identity_key")).alias("slug"))
    return build_packages(resolved, scope, slugs, organisations, groups, spec, programme, phrases)[0]
