"""GitHub repositories to observations.

A payload is ``{repository, head_ref, latest_release, readme, _resolved}``, the last
holding what the badge resolution settled: ``doi``, ``version_doi``, ``dropped_dois``
and the tasks the discovery route is configured for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions import text as tx
from ledgerfold.functions.html import sanitise_html
from ledgerfold.functions.jsonval import get_doc, get_strings, json_array, json_object, quote
from ledgerfold.operators.changes import payload_hash, stamp
from ledgerfold.sources import observation as ob

MAPPING_VERSION = 2


def source_key(doc: Column) -> Column:
    """Head commit, release tag, and a hash of what the page shows."""
    head = F.coalesce(ob.get(doc, "$.head_ref.object.sha"), F.lit(""))
    tag = F.coalesce(ob.get(doc, "$.latest_release.tag_name"), F.lit(""))
    shown = json_object([
        ("description", F.coalesce(quote(ob.get(doc, "$.repository.description")), F.lit("null"))),
        ("topics", F.to_json(F.array_sort(get_strings(doc, "$.repository.topics")))),
        ("license", F.coalesce(quote(ob.get(doc, "$.repository.license.spdx_id")), F.lit("null"))),
    ])
    return stamp(F.concat_ws(":", head, tag, payload_hash(shown)), MAPPING_VERSION)


def iso_day(stamp_text: Column) -> Column:
    text = tx.strip(stamp_text)
    return F.when(F.length(text) >= 10, F.substring(text, 1, 10))


@ob.register_mapper("github")
def map_github(raw: DataFrame, task_field: str = "task") -> DataFrame:
    rows = ob.with_doc(raw)
    doc = F.col("doc")
    repo = lambda p: ob.get(doc, f"$.repository.{p}")
    flag = lambda p: F.coalesce(F.try_variant_get(doc, f"$.repository.{p}", "boolean"), F.lit(False))
    described = tx.strip(F.coalesce(repo("description"), F.lit("")))
    rows = rows.withColumn("_notes", F.when(described != "", sanitise_html(described)))
    doi = tx.normalise_doi(ob.get(doc, "$._resolved.doi"))
    page, tag = tx.blank_to_null(repo("html_url")), tx.blank_to_null(ob.get(doc, "$.latest_release.tag_name"))
    release = tx.blank_to_null(ob.get(doc, "$.latest_release.html_url"))
    resources = F.array_compact(F.array(
        F.when(page.isNotNull(), json_object([
            ("url", quote(page)), ("name", F.lit('"Source repository"')), ("format", F.lit('"git"'))])),
        F.when(release.isNotNull() & tag.isNotNull(), json_object([
            ("url", quote(release)), ("name", quote(F.concat(F.lit("Release "), tag))), ("format", F.lit('"release"'))])),
    ))
    version_doi = tx.blank_to_null(ob.get(doc, "$._resolved.version_doi"))
    related = F.when(doi.isNotNull() & version_doi.isNotNull(), F.array(json_object([
        ("relation", F.lit('"HasVersion"')), ("identifier", quote(version_doi)), ("identifier_type", F.lit('"DOI"'))]))
    ).otherwise(F.array().cast("array<string>"))
    archived = flag("archived")
    verbatim = lambda p: F.when(F.to_json(get_doc(doc, p)) != "null", F.to_json(get_doc(doc, p)))
    extra = json_object([
        ("github_repo_id", verbatim("$.repository.id")), ("github_full_name", verbatim("$.repository.full_name")),
        ("github_owner", verbatim("$.repository.owner.login")),
        ("github_default_branch", verbatim("$.repository.default_branch")),
        ("github_head_sha", verbatim("$.head_ref.object.sha")), ("github_archived", archived.cast("string")),
        ("github_fork", flag("fork").cast("string")), ("github_size_kb", verbatim("$.repository.size")),
        ("github_language", ob.raw_json(doc, "$.repository.language")),
        ("github_homepage", ob.raw_json(doc, "$.repository.homepage")),
        ("github_dropped_badge_dois", ob.raw_json(doc, "$._resolved.dropped_dois")),
    ])
    licence = repo("license.spdx_id")
    topics = get_strings(doc, "$.repository.topics")
    tasks = get_strings(doc, f"$._resolved.{task_field}")
    fields = {
        "title": quote(F.coalesce(tx.blank_to_null(repo("full_name")), F.col("source_id"))), "notes": quote(F.col("_notes")),
        "doi": quote(doi), "url": quote(page), "source_urls": ob.strings(F.array_compact(F.array(page))), "authors": F.lit("[]"),
        "publisher": F.lit('"GitHub"'),
        "published_date": quote(iso_day(F.coalesce(tx.blank_to_null(ob.get(doc, "$.latest_release.published_at")), repo("created_at")))),
        "version": quote(ob.get(doc, "$.latest_release.tag_name")), "license_raw": quote(licence),
        "license_id": quote(ob.mapped_licence(licence)), "resource_kind": F.lit('"software"'),
        "access_status": F.when(F.to_json(get_doc(doc, "$.repository.private")) == "false", '"open"').otherwise('"unknown"'),
        "keywords": ob.strings(topics), "resources": json_array(resources), "related_identifiers": json_array(related),
        task_field: ob.strings(tasks), "withdrawn": F.lit("false"), "archived": F.when(archived, "true"), "extra": extra,
    }
    return ob.observations(
        rows, "github", tx.identity_key(doi, F.lit("github"), F.col("source_id")), F.col("source_id"), source_key(doc), fields,
        {
            "title": ("api", None), "license_id": ("pattern", None), "resource_kind": ("pattern", None),
            "published_date": ("api", None), "notes": ("api", F.col("_notes").isNotNull()),
            "keywords": ("api", F.size(topics) > 0), "version": ("api", tag.isNotNull()),
            "doi": ("pattern", doi.isNotNull()), task_field: ("pattern", F.size(tasks) > 0),
        },
    )
