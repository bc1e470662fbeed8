"""Linked-data and site-index exports, one row per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions import text as tx
from ledgerfold.functions.jsonval import json_object, quote
from ledgerfold.operators.classify import lookup
from ledgerfold.operators.listing import listed
from ledgerfold.operators.packages import extra, extra_list
from ledgerfold.sources.registers import LICENCE_IRIS

# The schema.org type of a resource kind.
SCHEMA_TYPES = {
    "dataset": "Dataset", "publication": "ScholarlyArticle", "software": "SoftwareSourceCode",
    "report": "Report", "model": "Dataset", "other": "CreativeWork",
}


def schema_type(kind: Column) -> Column:
    return F.coalesce(lookup(SCHEMA_TYPES, F.coalesce(kind, F.lit("dataset"))), F.lit("Dataset"))


def licence_iri(licence: Column) -> Column:
    """A licence page only where the register can stand behind it."""
    return lookup(LICENCE_IRIS, licence)


def access_conditions(status: Column, embargo: Column) -> Column:
    return F.when(
        F.coalesce(status, F.lit("open")) != "open",
        F.when((status == "embargoed") & embargo.isNotNull(), F.concat(F.lit("Embargoed until "), embargo))
        .otherwise(F.replace(status, F.lit("-"), F.lit(" "))),
    )


def _text(value: Column) -> Column:
    return quote(tx.blank_to_null(value))


def _list(items: Column) -> Column:
    """JSON array of JSON texts; an empty one is left out of its document."""
    return F.when(F.size(items) > 0, F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")))


def _keywords(task_titles: Column) -> Column:
    words = F.concat(F.transform("tags", lambda t: t["name"]), task_titles)
    return _list(F.transform(words, quote))


def _node(kind: str, entries: list[tuple[str, Column]]) -> Column:
    return json_object([("@type", F.lit(f'"{kind}"')), *entries])


def dcat_datasets(packages: DataFrame, base: str, task_titles: Column | None = None) -> DataFrame:
    """``(name, document)``: one ``dcat:Dataset`` node per listed record."""
    doi, publisher = extra("doi"), extra("publisher")
    titles = extra_list("task") if task_titles is None else task_titles
    distribution = F.transform(
        "resources",
        lambda r: _node("dcat:Distribution", [
            ("dcat:accessURL", _text(r["url"])), ("dct:title", _text(r["name"])),
            ("dcat:mediaType", _text(r["format"]))]),
    )
    node = _node("dcat:Dataset", [
        ("@id", quote(F.concat(F.lit(f"{base}/record/"), "name", F.lit("/")))),
        ("dct:identifier", _text(F.coalesce(F.concat(F.lit("https://doi.org/"), doi), extra("identity_key")))),
        ("dct:title", _text(F.col("title"))),
        ("dct:description", _text(tx.plain_text(F.col("notes")))),
        ("dct:issued", _text(extra("published_date"))),
        ("dct:modified", _text(extra("last_seen"))),
        ("dct:publisher", F.when(publisher.isNotNull(), _node("foaf:Agent", [("foaf:name", quote(publisher))]))),
        ("dct:license", quote(licence_iri(F.col("license_id")))),
        ("dct:type", _text(extra("resource_kind"))),
        ("dcat:keyword", _keywords(titles)),
        ("dcat:landingPage", _text(extra("source_url"))),
        ("dcat:distribution", _list(distribution)),
    ])
    return listed(packages).select("name", node.alias("document"))


def dcat_header(base: str, title: str, description: str, modified: str | None) -> str:
    """The catalogue node the dataset rows belong to, without the rows."""
    import json

    head = {
        "@context": {
            "dcat": "http://www.w3.org/ns/dcat#", "dct": "http://purl.org/dc/terms/",
            "foaf": "http://xmlns.com/foaf/0.1/", "vcard": "http://www.w3.org/2006/vcard/ns#",
        },
        "@type": "dcat:Catalog", "@id": f"{base}/catalog.jsonld", "dct:title": title,
        "dct:description": description,
        "dct:license": "https://creativecommons.org/publicdomain/zero/1.0/",
    }
    if modified:
        head["dct:modified"] = modified
    return json.dumps(head, ensure_ascii=False)


def schema_org(packages: DataFrame, base: str, task_titles: Column | None = None) -> DataFrame:
    """``(name, document)``: schema.org JSON-LD of every record page."""
    doi, publisher = extra("doi"), extra("publisher")
    titles = extra_list("task") if task_titles is None else task_titles
    address = F.concat(F.lit(f"{base}/record/"), F.col("name"), F.lit("/"))
    people = F.from_json(extra("authors"), "array<struct<name:string,orcid:string,affiliation:string>>")
    creators = F.transform(
        F.coalesce(people, F.array().cast("array<struct<name:string,orcid:string,affiliation:string>>")),
        lambda a: _node("Person", [
            ("name", _text(a["name"])),
            ("identifier", _text(F.concat(F.lit("https://orcid.org/"), tx.blank_to_null(a["orcid"])))),
            ("affiliation", F.when(F.coalesce(a["affiliation"], F.lit("")) != "",
                                   _node("Organization", [("name", quote(a["affiliation"]))])))]),
    )
    distribution = F.transform(
        "resources",
        lambda r: _node("DataDownload", [
            ("contentUrl", _text(r["url"])), ("name", _text(r["name"])), ("encodingFormat", _text(r["format"]))]),
    )
    withdrawn = (extra("lifecycle_state") == "withdrawn") | (extra("withdrawn") == "true")
    status = extra("access_status")
    node = json_object([
        ("@context", F.lit('"https://schema.org"')),
        ("@type", quote(schema_type(extra("resource_kind")))),
        ("@id", quote(address)), ("url", quote(address)),
        ("name", _text(F.col("title"))),
        ("description", _text(tx.plain_text(F.col("notes")))),
        ("identifier", quote(F.concat(F.lit("https://doi.org/"), doi))),
        ("sameAs", _list(F.transform(extra_list("source_urls"), quote))),
        ("datePublished", _text(extra("published_date"))),
        ("version", _text(F.col("version"))),
        ("inLanguage", F.lit('"en"')),
        ("creator", _list(creators)),
        ("publisher", F.when(publisher.isNotNull(), _node("Organization", [("name", quote(publisher))]))),
        ("license", quote(licence_iri(F.col("license_id")))),
        ("keywords", _keywords(titles)),
        ("isAccessibleForFree", F.when(status == "open", "true")),
        ("conditionsOfAccess", quote(access_conditions(status, extra("embargo_date")))),
        ("creativeWorkStatus", F.when(F.coalesce(withdrawn, F.lit(False)), '"Withdrawn"')),
        ("distribution", _list(distribution)),
    ])
    return packages.select("name", node.alias("document"))


def site_index(packages: DataFrame, base: str) -> DataFrame:
    """``(loc, lastmod)`` of the listed records."""
    return listed(packages).select(
        F.concat(F.lit(f"{base}/record/"), "name", F.lit("/")).alias("loc"),
        F.substring(extra("last_seen"), 1, 10).alias("lastmod"),
    )


def site_index_entry(loc: Column, lastmod: Column) -> Column:
    """One index line as markup."""
    return F.concat(
        F.lit("<url><loc>"), loc, F.lit("</loc>"),
        F.coalesce(F.concat(F.lit("<lastmod>"), lastmod, F.lit("</lastmod>")), F.lit("")), F.lit("</url>"),
    )


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON document per line, in as many files as there are tasks."""
    documents.select(F.col("document").alias("value")).write.mode("overwrite").text(path)
