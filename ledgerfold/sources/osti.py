"""OSTI records to observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions import text as tx
from ledgerfold.functions.html import sanitise_html
from ledgerfold.functions.jsonval import get_doc, get_list, json_array, json_object, json_type, let, quote
from ledgerfold.operators.changes import payload_hash, stamp
from ledgerfold.operators.classify import lookup
from ledgerfold.sources import observation as ob

MAPPING_VERSION = 2
BIBLIO = "https://www.osti.gov/biblio/"
OWN_PREFIXES = ("10.2172", "10.21947", "10.11578")

# Product types, and the fields a change token hashes.
KINDS = {
    "technical report": "report", "program document": "report", "report": "report",
    "journal article": "publication", "conference": "publication", "book": "publication",
    "thesis/dissertation": "publication", "dataset": "dataset", "software": "software",
    "patent": "other", "miscellaneous": "other",
}
TOKEN_FIELDS = (
    "title", "description", "doi", "publication_date", "product_type", "report_number", "authors",
    "subjects", "journal_name", "journal_volume", "journal_issue", "publisher", "links",
)
ORCID = r"\(\s*ORCID\s*:\s*([0-9Xx\-]{16,25})\s*\)"
AFFILIATION = r"\[([^\[\]]*)\]"


def source_key(doc: Column) -> Column:
    shown = json_object([(f, F.coalesce(F.to_json(get_doc(doc, f"$.{f}")), F.lit("null"))) for f in TOKEN_FIELDS])
    return stamp(F.coalesce(ob.stripped(doc, "$.entry_date"), payload_hash(shown)), MAPPING_VERSION)


def author_of(entry: Column) -> Column:
    """JSON of one creator; a string packs affiliation and ORCID into the name."""
    stated = F.coalesce(ob.stripped(entry, "$.name"), ob.stripped(entry, "$.full_name"))
    from_object = F.when(stated.isNotNull(), json_object([
        ("name", quote(stated)), ("orcid", quote(tx.orcid_dashed(tx.blank_to_null(ob.get(entry, "$.orcid"))))),
        ("affiliation", quote(ob.stripped(entry, "$.affiliation")))]))

    def from_text(text: Column) -> Column:
        raw_orcid = F.regexp_extract(text, ORCID, 1)
        rest = F.regexp_replace(text, "^((?:(?!" + ORCID + r").)*)" + ORCID, "$1")
        place = F.regexp_extract(rest, AFFILIATION, 1)
        bare = F.regexp_replace(rest, r"^([^\[\]]*(?:\[(?![^\[\]]*\])[^\[\]]*)*)" + AFFILIATION, "$1")
        name = tx.strip(F.regexp_replace(tx.collapse(bare), r"^,+|,+$", ""))
        return F.when(name != "", json_object([
            ("name", quote(name)), ("orcid", F.when(raw_orcid != "", quote(tx.orcid_dashed(raw_orcid)))),
            ("affiliation", ob.truthy(tx.strip(place)))]))

    plain = F.coalesce(F.try_variant_get(entry, "$", "string"), F.lit(""))
    return F.when(json_type(entry) == "OBJECT", from_object).otherwise(let(plain, from_text))


def link_of(doc: Column, rel: str) -> Column:
    links = F.filter(ob.only_objects(get_list(doc, "$.links")), lambda l: (
        F.lower(F.trim(ob.get(l, "$.rel"))) == rel) & ob.stripped(l, "$.href").isNotNull())
    return ob.stripped(F.get(links, F.lit(0)), "$.href")


@ob.register_mapper("osti")
def map_osti(
    raw: DataFrame, task_pattern: str | None = None, tasks: dict[str, str] | None = None, task_field: str = "task"
) -> DataFrame:
    """``task_pattern`` (two number groups) finds mentions; ``tasks`` maps the names they
    give to registered ones, old numbers included."""
    rows = ob.with_doc(raw)
    doc = F.col("doc")
    rows = rows.withColumns({
        "_notes": sanitise_html(ob.get(doc, "$.description")),
        "_id": F.coalesce(ob.stripped(doc, "$.osti_id"), tx.strip(F.col("source_id"))),
        "_doi": tx.normalise_doi(ob.get(doc, "$.doi")),
    })
    ident, doi = F.col("_id"), F.col("_doi")
    biblio = F.concat(F.lit(BIBLIO), ident)
    cited = F.array_distinct(F.array_compact(F.transform(
        F.filter(ob.only_objects(get_list(doc, "$.links")), lambda l: F.lower(F.trim(ob.get(l, "$.rel"))).startswith("citation")),
        lambda l: ob.stripped(l, "$.href"))))
    landing = F.coalesce(F.get(cited, F.lit(0)), tx.blank_to_null(F.col("url")), biblio)
    urls = F.when(F.array_contains(cited, landing), cited).otherwise(F.concat(F.array(landing), cited))
    product = ob.stripped(doc, "$.product_type")
    fulltext = link_of(doc, "fulltext")
    number, licence = ob.stripped(doc, "$.report_number"), ob.stripped(doc, "$.rights")
    external = doi.isNotNull() & ~F.substring_index(doi, "/", 1).isin(*OWN_PREFIXES)
    same = lambda value, kind: json_object([
        ("relation", F.lit('"IsIdenticalTo"')), ("identifier", quote(value)), ("identifier_type", F.lit(f'"{kind}"'))])
    related = F.array_compact(F.array(
        same(ident, "OSTI"), F.when(number.isNotNull(), same(number, "Report-Number")),
        F.when(external, json_object([
            ("relation", F.lit('"IsVariantFormOf"')), ("identifier", quote(biblio)), ("identifier_type", F.lit('"URL"'))]))))
    subjects = F.when(json_type(get_doc(doc, "$.subjects")) == "ARRAY", F.transform(
        get_list(doc, "$.subjects"), lambda s: F.coalesce(F.try_variant_get(s, "$", "string"), F.lit(""))))
    # A comma without a space separates packed subjects; one with a space is part of a name.
    words = F.array_distinct(F.filter(F.transform(
        F.flatten(F.transform(F.coalesce(subjects, F.array().cast("array<string>")), lambda s: F.split(s, r",(?!\s)"))),
        tx.collapse), lambda w: w != ""))
    published = ob.stripped(doc, "$.publication_date")
    day = F.trim(F.substring_index(published, "T", 1))
    found = F.array().cast("array<string>")
    if task_pattern:
        texts = F.array_compact(F.array(ob.get(doc, "$.title"), ob.get(doc, "$.description")))
        found = ob.known_tasks(F.flatten(F.transform(texts, lambda t: tx.task_mentions(t, task_pattern, 2))), tasks)
    kept = (
        "report_number", "doe_contract_number", "conference_info", "availability", "country_publication", "language",
        "journal_name", "journal_volume", "journal_issue", "journal_issn", "article_type",
    )
    lists = lambda k: F.when((json_type(get_doc(doc, f"$.{k}")) == "ARRAY"), ob.raw_json(doc, f"$.{k}"))
    extra = json_object([
        ("osti_id", quote(ident)), ("osti_product_type", F.coalesce(quote(product), F.lit("null"))),
        ("osti_entry_date", F.coalesce(quote(ob.stripped(doc, "$.entry_date")), F.lit("null"))),
        ("osti_doi_registrant", F.when(doi.isNotNull(), F.when(external, '"external"').otherwise('"osti"'))),
        ("osti_mandated_deposit", F.when(external, "true")),
        *[(f"osti_{k}", quote(ob.stripped(doc, f"$.{k}"))) for k in kept],
        ("osti_research_orgs", lists("research_orgs")), ("osti_sponsor_orgs", lists("sponsor_orgs")),
    ])
    authors = json_array(F.array_compact(F.transform(get_list(doc, "$.authors"), author_of)))
    fields = {
        "title": quote(ob.stripped(doc, "$.title")), "notes": quote(F.col("_notes")), "doi": quote(doi), "url": quote(landing),
        "source_urls": ob.strings(urls), "authors": authors, "publisher": quote(ob.stripped(doc, "$.publisher")),
        "published_date": quote(F.when(day.rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$"), day).otherwise(published)),
        "license_raw": quote(licence), "license_id": quote(ob.mapped_licence(licence)),
        "resource_kind": quote(F.coalesce(lookup(KINDS, F.lower(product)), F.lit("other"))),
        "access_status": F.when(fulltext.isNotNull(), '"open"').otherwise('"metadata-only"'),
        "container": quote(ob.stripped(doc, "$.journal_name")), "keywords": ob.strings(words),
        "resources": json_array(F.when(fulltext.isNotNull(), F.array(json_object([
            ("url", quote(fulltext)), ("name", F.lit('"Full text at OSTI"'))]))).otherwise(F.array().cast("array<string>"))),
        "related_identifiers": json_array(related), task_field: ob.strings(found), "withdrawn": F.lit("false"),
        "extra": extra, "report_number": quote(number),
    }
    always = ("title", "notes", "authors", "published_date", "resource_kind", "access_status", "keywords", "related_identifiers")
    return ob.observations(
        rows, "osti", tx.identity_key(doi, F.lit("osti"), ident), ident, source_key(doc), fields,
        {
            **{k: ("api", None) for k in always}, "license_id": ("pattern", None), "doi": ("api", doi.isNotNull()),
            "report_number": ("api", number.isNotNull()), task_field: ("pattern", F.size(found) > 0),
        },
    )
