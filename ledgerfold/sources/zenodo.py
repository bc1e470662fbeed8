"""Zenodo records to observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions import text as tx
from ledgerfold.functions.html import sanitise_html
from ledgerfold.functions.jsonval import get_doc, get_list, json_array, json_object, json_type, quote
from ledgerfold.operators.changes import payload_hash, stamp
from ledgerfold.operators.classify import lookup
from ledgerfold.operators.curation import is_tombstone
from ledgerfold.sources import observation as ob

MAPPING_VERSION = 3
DOI_PATTERN = r"^10\.5281/zenodo\.(\d+)$"

# Zenodo's vocabularies.
KINDS = {
    "dataset": "dataset", "software": "software", "model": "model", "publication": "publication",
    "poster": "other", "presentation": "other", "image": "other", "video": "other",
    "lesson": "other", "physicalobject": "other", "event": "other", "workflow": "other",
    "other": "other",
}
REPORT_SUBTYPES = ("report", "deliverable", "technicalnote", "milestone")
ACCESS = {"open": "open", "restricted": "restricted", "embargoed": "embargoed", "closed": "metadata-only"}


def source_key(doc: Column) -> Column:
    revision = F.coalesce(ob.get(doc, "$.revision"), ob.get(doc, "$.revision_id"))
    version = tx.normalise_doi(_version_doi(doc))
    key = tx.blank_to_null(F.concat_ws("@", revision, version))
    return stamp(F.coalesce(key, payload_hash(F.to_json(F.coalesce(get_doc(doc, "$.metadata"), doc)))), MAPPING_VERSION)


def _version_doi(doc: Column) -> Column:
    return F.coalesce(tx.blank_to_null(ob.get(doc, "$.doi")), ob.get(doc, "$.metadata.doi"))


def url_path(text: Column) -> Column:
    """Percent-encoding of a path: slashes and unreserved characters stay."""
    coded = F.url_encode(text)
    for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        coded = F.replace(coded, F.lit(a), F.lit(b))
    return coded


def kind_of(resource_type: Column) -> Column:
    kind = F.lower(ob.stripped(resource_type, "$.type"))
    subtype = F.lower(ob.stripped(resource_type, "$.subtype"))
    return F.when((kind == "publication") & F.coalesce(subtype.isin(*REPORT_SUBTYPES), F.lit(False)), "report").when(
        kind.isNotNull(), F.coalesce(lookup(KINDS, kind), F.lit("other"))
    )


def community_tasks(
    slug: Column, declared: dict[str, list[str]], tasks: dict[str, str] | None, pattern: str | None
) -> Column:
    """Tasks a community stands for: as declared, else the number its name spells out."""
    none = F.array().cast("array<string>")
    named = none
    if pattern:
        number = F.regexp_extract(F.regexp_replace(F.lower(slug), r"[^a-z0-9]+", ""), pattern + r"0*(\d{1,3})", 1)
        named = F.when(number != "", F.array(F.concat(F.lit("task-"), number.cast("int")))).otherwise(none)
    if declared:
        import json

        table = F.from_json(F.lit(json.dumps(declared)), "map<string,array<string>>")
        stated = F.transform(F.element_at(table, slug), tx.normalise_task)
        named = F.coalesce(stated, named)
    return ob.known_tasks(named, tasks)


@ob.register_mapper("zenodo")
def map_zenodo(
    raw: DataFrame,
    declared: dict[str, list[str]] | None = None,
    tasks: dict[str, str] | None = None,
    community_pattern: str | None = None,
    task_field: str = "task",
) -> DataFrame:
    """``community_pattern`` is the prefix, without punctuation, of communities that end
    in a task number."""
    rows = ob.with_doc(raw)
    doc = F.col("doc")
    meta = lambda p: ob.get(doc, f"$.metadata.{p}")
    landing = F.coalesce(tx.blank_to_null(ob.get(doc, "$.links.self_html")), F.col("url"))
    rows = rows.withColumns(
        {
            "_landing": landing,
            "_version": tx.normalise_doi(_version_doi(doc)),
            "_concept": tx.normalise_doi(ob.get(doc, "$.conceptdoi")),
            "_notes": tx.blank_to_null(sanitise_html(meta("description"))),
            "_gone": is_tombstone(doc),
        }
    )
    version, concept, landing, gone = (F.col(c) for c in ("_version", "_concept", "_landing", "_gone"))
    doi = F.coalesce(concept, version)
    licence = get_doc(doc, "$.metadata.license")
    licence_raw = tx.blank_to_null(tx.strip(
        F.when(json_type(licence) == "OBJECT", F.coalesce(tx.blank_to_null(ob.get(licence, "$.id")), ob.get(licence, "$.identifier")))
        .otherwise(F.try_variant_get(licence, "$", "string"))
    ))
    rtype = get_doc(doc, "$.metadata.resource_type")
    slugs = F.transform(
        get_list(doc, "$.metadata.communities"),
        lambda c: F.when(json_type(c) == "OBJECT", ob.get(c, "$.id")).otherwise(F.try_variant_get(c, "$", "string")),
    )
    named = F.array_distinct(F.flatten(F.transform(
        F.coalesce(slugs, F.array().cast("array<string>")),
        lambda s: community_tasks(tx.strip(F.coalesce(s, F.lit(""))), declared or {}, tasks, community_pattern),
    )))
    suffix = lambda key: F.when(key.contains("."), F.lower(tx.blank_to_null(F.substring_index(key, ".", -1))))
    files = ob.objects(
        get_list(doc, "$.files"),
        lambda e: [
            ("url", quote(F.concat(landing, F.lit("/files/"), url_path(ob.get(e, "$.key"))))),
            ("name", quote(ob.get(e, "$.key"))),
            ("format", quote(F.coalesce(F.lower(tx.blank_to_null(ob.get(e, "$.type"))), suffix(ob.get(e, "$.key"))))),
        ],
        lambda e: (F.coalesce(ob.get(e, "$.key"), F.lit("")) != "") & landing.isNotNull(),
    )
    version_of = json_object([
        ("relation", F.lit('"IsVersionOf"')), ("identifier", quote(concept)), ("identifier_type", F.lit('"DOI"'))])
    related = F.concat(
        F.when(concept.isNotNull() & version.isNotNull() & (concept != version), F.array(version_of))
        .otherwise(F.array().cast("array<string>")),
        F.transform(
            F.filter(get_list(doc, "$.metadata.related_identifiers"),
                     lambda e: F.coalesce(ob.get(e, "$.identifier"), F.lit("")) != ""),
            lambda e: json_object([
                ("relation", quote(ob.get(e, "$.relation"))), ("identifier", quote(ob.get(e, "$.identifier"))),
                ("identifier_type", quote(F.upper(tx.blank_to_null(ob.get(e, "$.scheme")))))]),
        ),
    )
    type_part = lambda k: ob.truthy(ob.get(rtype, f"$.{k}"))
    extra = json_object([
        ("zenodo_record_id", F.to_json(get_doc(doc, "$.id"))),
        ("zenodo_concept_recid", F.to_json(get_doc(doc, "$.conceptrecid"))),
        ("zenodo_version_doi", quote(version)),
        ("zenodo_resource_type", F.when(json_type(rtype) == "OBJECT", json_object([
            (k, type_part(k)) for k in ("type", "subtype", "title")]))),
        ("zenodo_code_repository", ob.truthy(ob.get(doc, "$.metadata.custom['code:codeRepository']"))),
    ])
    authors = ob.objects(
        get_list(doc, "$.metadata.creators"),
        lambda c: [("name", quote(ob.get(c, "$.name"))), ("orcid", ob.truthy(ob.get(c, "$.orcid"))),
                   ("affiliation", ob.truthy(ob.get(c, "$.affiliation")))],
        lambda c: F.coalesce(ob.get(c, "$.name"), F.lit("")) != "",
    )
    title = F.coalesce(tx.blank_to_null(meta("title")), ob.get(doc, "$.title"))
    kind = kind_of(rtype)
    container = F.coalesce(*[tx.blank_to_null(ob.get(doc, f"$.metadata.{b}.title")) for b in ("journal", "meeting", "imprint")])
    words = F.transform(get_list(doc, "$.metadata.keywords"), lambda k: F.try_variant_get(k, "$", "string"))
    fields = {
        "title": quote(title), "notes": quote(F.col("_notes")), "doi": quote(doi), "url": quote(landing),
        "source_urls": ob.strings(F.array_compact(F.array(landing))), "authors": authors,
        "publisher": quote(F.coalesce(tx.blank_to_null(meta("imprint_publisher")), F.lit("Zenodo"))),
        "published_date": quote(meta("publication_date")), "version": quote(meta("version")),
        "license_raw": quote(licence_raw), "license_id": quote(ob.mapped_licence(licence_raw)),
        "resource_kind": quote(kind),
        "access_status": quote(F.when(gone, "metadata-only").otherwise(
            F.coalesce(lookup(ACCESS, F.lower(ob.stripped(doc, "$.metadata.access_right"))), F.lit("unknown")))),
        "embargo_date": quote(meta("embargo_date")), "container": quote(container),
        "keywords": ob.strings(words), "resources": files, "related_identifiers": json_array(related),
        task_field: ob.strings(named), "withdrawn": gone.cast("string"), "extra": extra,
    }
    return ob.observations(
        rows, "zenodo", tx.identity_key(doi, F.lit("zenodo"), F.col("source_id")), F.col("source_id"), source_key(doc),
        fields,
        {
            "license_id": ("pattern", None), "title": ("api", title != ""), "notes": ("api", F.col("_notes").isNotNull()),
            "doi": ("api", doi.isNotNull()), "authors": ("api", authors != "[]"), "resource_kind": ("api", kind.isNotNull()),
            task_field: ("pattern", F.size(named) > 0),
        },
    )
