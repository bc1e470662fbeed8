"""Crossref works to observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions import text as tx
from ledgerfold.functions.html import html_to_text, sanitise_html, texts_of_each, unwrap_jats
from ledgerfold.functions.jsonval import get_doc, get_list, json_array, json_object, quote
from ledgerfold.operators.changes import payload_hash, stamp
from ledgerfold.operators.classify import lookup
from ledgerfold.sources import observation as ob

MAPPING_VERSION = 2

# Crossref's types, relations and date precedence.
KINDS = {
    **dict.fromkeys(("report", "report-component", "report-series", "standard", "standard-series"), "report"),
    **dict.fromkeys(("dataset", "database"), "dataset"),
    **dict.fromkeys(("component", "peer-review", "grant", "other"), "other"),
}
RETRACTIONS = ("retraction", "withdrawal", "removal")
RELATIONS = {
    "is-preprint-of": "IsPreprintOf", "has-preprint": "HasPreprint",
    "is-supplement-to": "IsSupplementTo", "has-review": "HasReview", "has-comment": "HasComment",
    "is-part-of": "IsPartOf",
}
DATES = ("issued", "published", "published-print", "published-online", "posted", "created")
VOLATILE = ("indexed", "deposited", "score", "is-referenced-by-count", "references-count", "reference-count")
LICENCE_RANK = {"vor": 0, "am": 1, "unspecified": 2, "tdm": 3}


def date_at(doc: Column, key: str) -> Column:
    parts = F.try_variant_get(doc, f"$['{key}']['date-parts'][0]", "array<int>")
    return tx.date_from_parts(F.array_compact(parts))


def published_date(doc: Column) -> Column:
    return F.coalesce(*[date_at(doc, k) for k in DATES])


def source_key(doc: Column) -> Column:
    """When the deposit was made, never when it was indexed."""
    stated = F.coalesce(tx.blank_to_null(ob.get(doc, "$.deposited['date-time']")),
                        tx.blank_to_null(ob.get(doc, "$.deposited.timestamp")), date_at(doc, "deposited"))
    content = F.map_filter(F.from_json(F.to_json(doc), "map<string,variant>"), lambda k, _: ~k.isin(*VOLATILE))
    whole = F.to_json(F.to_variant_object(content))
    return stamp(F.coalesce(stated, payload_hash(whole)), MAPPING_VERSION)


def relation_name(raw: Column) -> Column:
    key = F.lower(F.trim(raw))
    camel = F.array_join(F.transform(F.filter(F.split(key, "[-_]"), lambda p: p != ""), F.initcap), "")
    return F.coalesce(lookup(RELATIONS, key), camel)


def published_version(doc: Column) -> Column:
    """The article a preprint says it became."""
    entries = ob.only_objects(get_list(doc, "$.relation['is-preprint-of']"))
    dois = F.transform(F.filter(entries, lambda e: F.lower(ob.get(e, "$['id-type']")) == "doi"),
                       lambda e: tx.normalise_doi(ob.get(e, "$.id")))
    return F.when(ob.get(doc, "$.type") == "posted-content", ob.first_of(dois))


def first_text(doc: Column, key: str) -> Column:
    """The first non-empty member of a string list, or the string itself."""
    items = F.transform(ob.as_list(get_doc(doc, f"$['{key}']")), lambda v: tx.blank_to_null(F.try_variant_get(v, "$", "string")))
    return F.coalesce(ob.first_of(items), F.lit(""))


def authors_of(doc: Column) -> Column:
    text = lambda e, k: tx.blank_to_null(tx.collapse(ob.get(e, f"$.{k}")))

    def name(e):
        given, family = text(e, "given"), text(e, "family")
        return F.coalesce(F.concat(family, F.lit(", "), given), family, text(e, "name"), given)

    def build(e):
        places = F.transform(ob.only_objects(get_list(e, "$.affiliation")), lambda a: text(a, "name"))
        return [("name", quote(name(e))), ("given", quote(text(e, "given"))), ("family", quote(text(e, "family"))),
                ("orcid", quote(tx.orcid(ob.get(e, "$.ORCID")))),
                ("affiliation", quote(tx.blank_to_null(F.array_join(F.array_compact(places), "; "))))]

    return ob.objects(ob.only_objects(get_list(doc, "$.author")), build, lambda e: name(e).isNotNull())


def licence_raw(doc: Column) -> Column:
    """The licence of the version a reader gets: record, manuscript, other, mining."""
    entries = F.filter(ob.only_objects(get_list(doc, "$.license")), lambda e: F.coalesce(ob.get(e, "$.URL"), F.lit("")) != "")
    ranked = F.transform(entries, lambda e, i: F.struct(
        F.coalesce(lookup(LICENCE_RANK, F.lower(ob.get(e, "$['content-version']"))), F.lit(2)).alias("rank"),
        i.alias("pos"), F.trim(ob.get(e, "$.URL")).alias("url")))
    return F.array_min(ranked)["url"]


def related_of(doc: Column, own: Column) -> Column:
    """JSON objects of relations and updates, once per (relation, identifier), never itself."""
    item = lambda rel, ident, kind: F.struct(rel.alias("r"), ident.alias("i"), kind.alias("t"))
    groups = F.array_sort(F.map_entries(F.coalesce(
        F.from_json(F.to_json(get_doc(doc, "$.relation")), "map<string,array<variant>>"),
        F.create_map().cast("map<string,array<variant>>"))), lambda a, b: F.when(a["key"] < b["key"], -1).otherwise(1))
    stated = F.flatten(F.transform(groups, lambda g: F.transform(
        ob.only_objects(g["value"]),
        lambda e: F.when(
            F.lower(ob.stripped(e, "$['id-type']")) == "doi",
            item(relation_name(g["key"]), tx.normalise_doi(ob.get(e, "$.id")), F.lit("DOI")),
        ).otherwise(item(relation_name(g["key"]), ob.stripped(e, "$.id"),
                         F.coalesce(F.upper(ob.stripped(e, "$['id-type']")), F.lit("OTHER")))))))

    def updates(key, retracted, tail):
        def one(e):
            kind = F.lower(F.trim(F.coalesce(ob.get(e, "$.type"), F.lit(""))))
            name = F.when(kind.isin(*RETRACTIONS), retracted).otherwise(F.concat(F.lit("Is"), relation_name(kind), F.lit(tail)))
            return item(name, tx.normalise_doi(ob.get(e, "$.DOI")), F.lit("DOI"))

        return F.transform(ob.only_objects(get_list(doc, f"$['{key}']")), one)

    every = F.concat(stated, updates("update-to", "IsRetractionOf", "Of"), updates("updated-by", "IsRetractedBy", "By"))
    kept = F.filter(every, lambda x: x["i"].isNotNull() & ~x["i"].eqNullSafe(own))
    first = F.filter(kept, lambda x, n: ~F.exists(
        F.slice(kept, F.lit(1), n), lambda y: (y["r"] == x["r"]) & (y["i"] == x["i"])))
    return F.transform(first, lambda x: json_object(
        [("relation", quote(x["r"])), ("identifier", quote(x["i"])), ("identifier_type", quote(x["t"]))]))


def retraction_of(doc: Column, own: Column) -> Column:
    """JSON of the retraction of this very work; a notice about another is none."""
    entries = F.concat(ob.only_objects(get_list(doc, "$['update-to']")), ob.only_objects(get_list(doc, "$['updated-by']")))
    target = lambda e: tx.normalise_doi(ob.get(e, "$.DOI"))
    hit = F.filter(entries, lambda e: F.coalesce(F.lower(F.trim(ob.get(e, "$.type"))).isin(*RETRACTIONS), F.lit(False))
                   & ~F.coalesce(target(e) != own, F.lit(False)))
    return F.get(F.transform(hit, lambda e: json_object([
        ("type", quote(F.lower(F.trim(ob.get(e, "$.type"))))),
        ("label", quote(F.coalesce(ob.stripped(e, "$.label"), F.lit("Retraction")))),
        ("source", F.coalesce(quote(ob.stripped(e, "$.source")), F.lit("null"))),
        ("retracted_date", F.coalesce(quote(date_at(e, "updated")), F.lit("null"))),
        ("doi", F.coalesce(quote(target(e)), F.lit("null")))])), F.lit(0))


@ob.register_mapper("crossref")
def map_crossref(
    raw: DataFrame, anchored_task: str | None = None, bare_task: str = r"(?i)\bTask[\s]*(\d{1,3})\b",
    task_field: str = "task",
) -> DataFrame:
    """``anchored_task`` finds mentions that name the programme; after one, bare
    mentions in the same text count too. All stay candidates."""
    rows = ob.with_doc(raw)
    doc = F.col("doc")
    rows = rows.withColumns({
        "_own": F.coalesce(tx.normalise_doi(ob.get(doc, "$.DOI")), tx.normalise_doi(F.col("source_id"))),
        "_became": published_version(doc),
        "_title_raw": first_text(doc, "title"),
        "_abstract": F.coalesce(ob.get(doc, "$.abstract"), F.lit("")),
        "_journal": first_text(doc, "container-title"),
        "_event": F.coalesce(ob.get(doc, "$.event.name"), F.lit("")),
    })
    plain = lambda c: tx.collapse(html_to_text(unwrap_jats(c)))
    rich = lambda c: tx.collapse(sanitise_html(unwrap_jats(c)))
    parts = ("subtitle", "short-container-title", "group-title")
    rows = rows.withColumns({
        "_title": plain(F.col("_title_raw")), "_title_html": rich(F.col("_title_raw")),
        "_notes": tx.blank_to_null(rich(F.col("_abstract"))),
        "_container": F.coalesce(tx.blank_to_null(plain(F.col("_journal"))), tx.blank_to_null(plain(F.col("_event")))),
        **{f"_p{i}": tx.blank_to_null(plain(first_text(doc, k))) for i, k in enumerate(parts)},
        "_words": F.transform(texts_of_each(F.transform(
            get_list(doc, "$.subject"), lambda s: unwrap_jats(F.try_variant_get(s, "$", "string")))), tx.collapse),
    })
    own, became, title = F.col("_own"), F.col("_became"), tx.blank_to_null(F.col("_title"))
    doi = F.coalesce(became, own)
    landing, primary = ob.stripped(doc, "$.URL"), ob.stripped(doc, "$.resource.primary.URL")
    doi_url = F.concat(F.lit("https://doi.org/"), doi)
    url = F.when(became.isNotNull(), doi_url).otherwise(F.coalesce(landing, primary, doi_url))
    urls = F.array_distinct(F.array_compact(F.when(became.isNotNull(), F.array(doi_url, landing, primary)).otherwise(F.array(url, primary))))
    raw_licence = licence_raw(doc)
    references = F.array_distinct(F.array_compact(F.transform(
        ob.only_objects(get_list(doc, "$.reference")), lambda r: tx.normalise_doi(ob.get(r, "$.DOI")))))
    words = F.array_distinct(F.filter(F.transform("_words", lambda w: F.trim(w)), lambda w: w != ""))
    related = related_of(doc, own)
    retraction = retraction_of(doc, own)
    candidates = F.array().cast("array<string>")
    if anchored_task:
        text = F.concat_ws(" ", "_title_raw", "_journal", "_abstract")
        named = tx.task_mentions(text, anchored_task)
        candidates = F.when(F.size(named) > 0, F.array_sort(F.array_union(named, tx.task_mentions(text, bare_task)))).otherwise(named)
    changed = (F.col("_title_raw") != "") & (F.col("_title_raw") != F.col("_title"))
    marked = (F.col("_title_html") != "") & (F.col("_title_html") != F.col("_title")) & ~(changed & (F.col("_title_html") == F.col("_title_raw")))
    extra = json_object([
        ("crossref_type", quote(F.coalesce(ob.get(doc, "$.type"), F.lit("")))),
        ("crossref_references", F.when(F.size(references) > 0, F.to_json(references))),
        ("crossref_title_raw", F.when(changed, quote(F.col("_title_raw")))),
        ("crossref_title_html", F.when(marked, quote(F.col("_title_html")))),
        ("crossref_subtitle", quote(F.col("_p0"))), ("crossref_short_container_title", quote(F.col("_p1"))),
        ("crossref_group_title", quote(F.col("_p2"))),
        *[(f"crossref_{k.replace('-', '_')}", ob.truthy(ob.get(doc, f"$['{k}']"))) for k in (
            "volume", "issue", "page", "article-number", "update-policy")],
        *[(name, ob.raw_json(doc, f"$['{k}']")) for name, k in (
            ("crossref_issn", "ISSN"), ("crossref_isbn", "ISBN"), ("crossref_event", "event"), ("crossref_links", "link"),
            ("crossref_update_to", "update-to"), ("crossref_updated_by", "updated-by"))],
        ("crossref_preprint_doi", F.when(became.isNotNull(), quote(own))),
        ("crossref_retraction", retraction),
        (f"{task_field}_candidates", F.when(F.size(candidates) > 0, F.to_json(candidates))),
    ])
    authors = authors_of(doc)
    publisher = tx.blank_to_null(tx.collapse(ob.get(doc, "$.publisher")))
    published = published_date(doc)
    kind = F.coalesce(lookup(KINDS, ob.get(doc, "$.type")), F.lit("publication"))
    fields = {
        "title": quote(title), "notes": quote(F.col("_notes")), "doi": quote(doi), "url": quote(url),
        "source_urls": ob.strings(urls), "authors": authors, "publisher": quote(publisher), "published_date": quote(published),
        "license_raw": quote(raw_licence), "license_id": quote(ob.mapped_licence(raw_licence)), "resource_kind": quote(kind),
        "container": quote(F.col("_container")), "keywords": ob.strings(words), "resources": F.lit("[]"),
        "related_identifiers": json_array(related), task_field: F.lit("[]"),
        "withdrawn": retraction.isNotNull().cast("string"), "extra": extra,
    }
    return ob.observations(
        rows, "crossref", tx.identity_key(doi, F.lit("crossref"), F.col("source_id"), title), F.col("source_id"),
        source_key(doc), fields,
        {
            "title": ("api", None), "doi": ("api", None), "published_date": ("api", None), "resource_kind": ("api", None),
            "license_id": ("pattern", None), "notes": ("api", F.col("_notes").isNotNull()), "authors": ("api", authors != "[]"),
            "publisher": ("api", publisher.isNotNull()), "container": ("api", F.col("_container").isNotNull()),
            "related_identifiers": ("api", F.size(related) > 0), "keywords": ("api", F.size(words) > 0),
            "withdrawn": ("pattern", retraction.isNotNull()),
        },
    )
