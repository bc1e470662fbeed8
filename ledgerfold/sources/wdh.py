"""Wind Data Hub datasets to observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions import text as tx
from ledgerfold.functions.html import sanitise_html
from ledgerfold.functions.jsonval import get_doc, get_list, get_strings, json_array, json_object, json_type, quote
from ledgerfold.operators.changes import payload_hash, stamp
from ledgerfold.sources import observation as ob

MAPPING_VERSION = 2
HOST = "wdh.energy.gov"
LEGACY = ("a2e.energy.gov", "www.a2e.energy.gov")


def canonical_url(url: Column) -> Column:
    """Old hosts rewritten to the present one; a default port is dropped."""
    text = F.trim(url)
    scheme = F.regexp_extract(text, r"^([a-zA-Z][a-zA-Z0-9+.-]*)://", 1)
    netloc = F.lower(F.regexp_extract(text, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rest = F.regexp_replace(text, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", "")
    host = F.substring_index(netloc, ":", 1)
    return (
        F.when(F.coalesce(text, F.lit("")) == "", F.lit(None))
        .when(netloc == "", text)
        .when(host.isin(*LEGACY), F.concat(F.lit(f"https://{HOST}"), rest))
        .when(netloc.rlike(r":(80|443)$"), F.concat(scheme, F.lit("://"), host, rest))
        .otherwise(text)
    )


def access_of(level: Column, restriction: Column) -> Column:
    """Two access fields as one status; "restricted public" needs an account."""
    a, b = F.lower(F.trim(F.coalesce(level, F.lit("")))), F.lower(F.trim(F.coalesce(restriction, F.lit(""))))
    free = b.isin("", "none")
    return (
        F.when((a == "public") & free, "open")
        .when(a.isin("restricted public", "restricted-public"), "registration-required")
        .when(a.isin("restricted", "private", "internal"), "restricted")
        .when(~free, "registration-required")
        .otherwise("unknown")
    )


def source_key(src: Column) -> Column:
    shown = json_object(
        [(k, F.coalesce(F.to_json(get_doc(src, f"$.{k}")), F.lit("null"))) for k in (
            "identifier", "title", "doiName", "description", "accessLevel", "accessRestriction")]
        + [(n, F.coalesce(F.to_json(get_doc(src, f"$.dapFileSummary.{k}")), F.lit("null"))) for n, k in (
            ("file_count", "count"), ("begins", "begins"), ("ends", "ends"))]
    )
    return stamp(F.coalesce(ob.stripped(src, "$.lastUpdated"), payload_hash(shown)), MAPPING_VERSION)


@ob.register_mapper("wdh")
def map_wdh(raw: DataFrame, task_field: str = "task") -> DataFrame:
    rows = ob.with_doc(raw).withColumn("src", F.coalesce(get_doc(F.col("doc"), "$._source"), F.col("doc")))
    src = F.col("src")
    text = lambda p: ob.stripped(src, f"$.{p}")
    rows = rows.withColumns({
        "_notes": sanitise_html(text("description")),
        "_id": F.coalesce(tx.blank_to_null(ob.get(src, "$.identifier")), F.col("source_id")),
    })
    ident = F.col("_id")
    doi = tx.normalise_doi(ob.get(src, "$.doiName"))
    page = F.concat(F.lit(f"https://{HOST}/ds/"), F.regexp_replace(ident, r"^/+|/+$", ""))
    url = F.coalesce(canonical_url(F.col("url")), page)
    title = F.coalesce(text("title"), ident)
    # What the one resource of a dataset says, and what a document's does.
    about = ("Dataset page at the Wind Data Hub. Individual files are listed and downloaded there; this catalogue "
             "links to datasets and never enumerates or mirrors their files.")
    dataset = json_object([("name", quote(title)), ("url", quote(url)), ("description", quote(F.lit(about)))])
    link = lambda r: canonical_url(ob.get(r, "$.referenceURL"))
    documents = F.transform(
        F.filter(ob.only_objects(get_list(src, "$.references")), lambda r: link(r).isNotNull()),
        lambda r: json_object([
            ("name", quote(F.coalesce(ob.stripped(r, "$.referenceTitle"), link(r)))), ("url", quote(link(r))),
            ("format", F.coalesce(quote(ob.stripped(r, "$.custom.fileExtension")), F.lit("null"))),
            ("description", F.lit('"Supporting document published alongside the dataset."'))]),
    )
    people = ob.objects(
        ob.only_objects(get_list(src, "$.contactPoint")),
        lambda c: [("name", quote(ob.stripped(c, "$.fn"))), ("affiliation", quote(ob.stripped(c, "$.hasOrg"))),
                   ("role", F.when(ob.stripped(c, "$.hasRole").isNotNull(), quote(ob.get(c, "$.hasRole"))))],
        lambda c: ob.stripped(c, "$.fn").isNotNull(),
    )
    words = F.array_distinct(F.array_compact(F.transform(
        F.concat(F.array(text("instrument"), text("dataLevel")), get_strings(src, "$.measurements"),
                 get_strings(src, "$.project.keywords")), lambda w: tx.blank_to_null(tx.strip(w)))))
    null = lambda c: F.coalesce(c, F.lit("null"))
    types = F.array_sort(F.array_distinct(get_strings(src, "$.dapFileSummary.types")))
    project = lambda p: F.when(json_type(get_doc(src, "$.project")) == "OBJECT", text(f"project.{p}"))
    extra = json_object([
        ("wdh_identifier", quote(ident)), ("wdh_project", null(quote(F.coalesce(text("projectName"), project("identifier"))))),
        ("wdh_project_title", null(quote(project("title")))), ("wdh_instrument", null(quote(text("instrument")))),
        ("wdh_data_level", null(quote(text("dataLevel")))), ("wdh_access_level", null(quote(text("accessLevel")))),
        ("wdh_access_restriction", null(quote(text("accessRestriction")))),
        ("temporal_coverage_start", null(quote(text("dapFileSummary.begins")))),
        ("temporal_coverage_end", null(quote(text("dapFileSummary.ends")))),
        ("spatial_coverage", null(ob.raw_json(src, "$.spatial"))),
        ("wdh_file_count", null(F.to_json(get_doc(src, "$.dapFileSummary.count")))),
        ("wdh_total_bytes", null(F.to_json(get_doc(src, "$.dapFileSummary.size")))),
        ("wdh_file_types", F.when(F.size(types) > 0, F.to_json(types)).otherwise("null")),
        ("wdh_files_enumerated", F.lit("false")),
    ])
    fields = {
        "title": quote(title), "notes": quote(F.col("_notes")), "doi": quote(doi), "url": quote(url),
        "source_urls": ob.strings(F.array(url)), "authors": people, "publisher": F.lit('"Wind Data Hub"'),
        "license_id": F.lit('"notspecified"'), "resource_kind": F.lit('"dataset"'),
        "access_status": quote(access_of(ob.get(src, "$.accessLevel"), ob.get(src, "$.accessRestriction"))),
        "container": quote(project("title")), "keywords": ob.strings(words),
        "resources": json_array(F.concat(F.array(dataset), documents)), "related_identifiers": F.lit("[]"),
        task_field: F.lit("[]"), "extra": extra,
    }
    return ob.observations(
        rows, "wdh", tx.identity_key(doi, F.lit("wdh"), ident), ident, source_key(src), fields,
        {
            "title": ("api", None), "notes": ("api", None), "authors": ("api", None), "resource_kind": ("pattern", None),
            "access_status": ("pattern", None), "license_id": ("pattern", None), "doi": ("api", doi.isNotNull()),
        },
    )
