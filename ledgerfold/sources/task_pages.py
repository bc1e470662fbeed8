"""DOIs found on task pages to observations, from what the DOI registries answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions import text as tx
from ledgerfold.functions.html import sanitise_html
from ledgerfold.functions.jsonval import get_doc, get_list, json_array, json_object, json_type, quote
from ledgerfold.operators.changes import payload_hash, stamp
from ledgerfold.operators.classify import lookup
from ledgerfold.sources import observation as ob

MAPPING_VERSION = 2
SYSTEM = "task_pages"

# The kinds each registry's types stand for here.
DATACITE_KINDS = {
    "dataset": "dataset", "software": "software", "text": "publication", "journalarticle": "publication",
    "conferencepaper": "publication", "report": "report", "model": "model", "preprint": "publication",
}
CROSSREF_KINDS = {
    "journal-article": "publication", "proceedings-article": "publication", "posted-content": "publication",
    "book-chapter": "publication", "report": "report", "dataset": "dataset", "component": "other", "monograph": "report",
}


def _named(items: Column, key: str) -> Column:
    """The first member with a value under ``key``."""
    return ob.first_of(F.transform(ob.only_objects(items), lambda i: tx.blank_to_null(ob.get(i, f"$.{key}"))))


def datacite_fields(doc: Column) -> dict[str, Column]:
    att = get_doc(doc, "$.data.attributes")
    att = F.coalesce(att, F.parse_json(F.lit("{}")))
    text = lambda p: ob.stripped(att, f"$.{p}")
    kinds = lambda *k: F.filter(ob.only_objects(get_list(att, "$.dates")), lambda d: F.lower(ob.get(d, "$.dateType")).isin(*k))
    day = lambda d: ob.stripped(d, "$.date")
    # The first issued date; without one the last available or created date.
    issued = F.get(F.transform(kinds("issued"), day), F.lit(0))
    other = F.try_element_at(F.transform(kinds("available", "created"), day), F.lit(-1))
    year = F.when(ob.get(att, "$.publicationYear") != "0", text("publicationYear"))
    rights = get_list(att, "$.rightsList")
    general = F.lower(F.coalesce(ob.get(att, "$.types.resourceTypeGeneral"), F.lit("")))
    described = F.filter(ob.only_objects(get_list(att, "$.descriptions")),
                         lambda d: F.lower(ob.get(d, "$.descriptionType")) == "abstract")

    def person(c):
        ids = F.filter(ob.only_objects(get_list(c, "$.nameIdentifiers")),
                       lambda i: F.upper(ob.get(i, "$.nameIdentifierScheme")) == "ORCID")
        place = get_doc(c, "$.affiliation")
        listed = get_list(c, "$.affiliation")
        first = F.get(listed, F.lit(0))
        name = F.when(json_type(place) == "ARRAY", F.coalesce(
            _named(listed, "name"), F.when(json_type(first) == "STRING", F.try_variant_get(first, "$", "string")))).otherwise(
            F.try_variant_get(place, "$", "string"))
        return [("name", quote(ob.stripped(c, "$.name"))), ("given", ob.truthy(ob.get(c, "$.givenName"))),
                ("family", ob.truthy(ob.get(c, "$.familyName"))),
                ("orcid", quote(ob.stripped(F.try_element_at(ids, F.lit(-1)), "$.nameIdentifier"))), ("affiliation", ob.truthy(name))]

    return {
        "title": tx.blank_to_null(tx.strip(_named(get_list(att, "$.titles"), "title"))),
        "markup": ob.get(F.get(described, F.lit(0)), "$.description"),
        "authors": ob.objects(ob.only_objects(get_list(att, "$.creators")), person,
                              lambda c: ob.stripped(c, "$.name").isNotNull()),
        "publisher": text("publisher"), "published": F.coalesce(issued, other, year), "version": text("version"),
        "licence": tx.strip(F.coalesce(_named(rights, "rightsIdentifier"), _named(rights, "rights"))),
        "kind": F.when(general != "", F.coalesce(lookup(DATACITE_KINDS, general), F.lit("other"))),
        "container": ob.stripped(att, "$.container.title"),
        "keywords": F.to_json(F.array_compact(F.transform(
            ob.only_objects(get_list(att, "$.subjects")), lambda s: tx.blank_to_null(tx.strip(ob.get(s, "$.subject")))))),
        "related": ob.objects(
            ob.only_objects(get_list(att, "$.relatedIdentifiers")),
            lambda r: [("relation", quote(F.coalesce(ob.get(r, "$.relationType"), F.lit("")))),
                       ("identifier", quote(ob.stripped(r, "$.relatedIdentifier"))),
                       ("identifier_type", quote(F.coalesce(ob.get(r, "$.relatedIdentifierType"), F.lit(""))))],
            lambda r: ob.stripped(r, "$.relatedIdentifier").isNotNull()),
        "url": text("url"),
    }


def crossref_fields(doc: Column) -> dict[str, Column]:
    msg = F.coalesce(get_doc(doc, "$.message"), F.parse_json(F.lit("{}")))
    text = lambda p: ob.stripped(msg, f"$['{p}']")
    first = lambda p: tx.blank_to_null(tx.strip(F.get(F.transform(
        get_list(msg, f"$['{p}']"), lambda v: F.try_variant_get(v, "$", "string")), F.lit(0))))
    parts = F.array_compact(F.try_variant_get(msg, "$.issued['date-parts'][0]", "array<int>"))
    published = F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p.cast("string")).otherwise(
        F.lpad(p.cast("string"), 2, "0"))), "-")

    def shown(p):
        family, given = ob.stripped(p, "$.family"), ob.stripped(p, "$.given")
        return F.coalesce(ob.stripped(p, "$.name"), F.when(family.isNotNull(), F.concat_ws(", ", family, given)), given)

    def person(p):
        return [("name", quote(shown(p))), ("given", quote(ob.stripped(p, "$.given"))),
                ("family", quote(ob.stripped(p, "$.family"))),
                ("orcid", quote(F.substring_index(ob.stripped(p, "$.ORCID"), "/", -1))),
                ("affiliation", quote(_named(get_list(p, "$.affiliation"), "name")))]

    licences = F.filter(ob.only_objects(get_list(msg, "$.license")), lambda e: F.coalesce(ob.get(e, "$.URL"), F.lit("")) != "")
    record = F.filter(licences, lambda e: ob.get(e, "$['content-version']") == "vor")
    return {
        "title": first("title"), "markup": ob.get(msg, "$.abstract"),
        "authors": ob.objects(ob.only_objects(get_list(msg, "$.author")), person, lambda p: shown(p).isNotNull()),
        "publisher": text("publisher"), "published": tx.blank_to_null(published), "version": F.lit(None).cast("string"),
        "licence": ob.get(F.coalesce(F.get(record, F.lit(0)), F.try_element_at(licences, F.lit(-1))), "$.URL"),
        "kind": F.coalesce(lookup(CROSSREF_KINDS, ob.get(msg, "$.type")), F.lit("publication")),
        "container": first("container-title"),
        "keywords": F.to_json(F.array_compact(F.transform(
            get_list(msg, "$.subject"), lambda s: tx.blank_to_null(tx.strip(F.try_variant_get(s, "$", "string")))))),
        "related": F.lit("[]"), "url": text("URL"),
    }


def task_page_payloads(sightings: DataFrame, answers: DataFrame, pages: DataFrame) -> DataFrame:
    """Payload rows: each DOI with its registry answer, tasks and the pages it is on.

    ``sightings`` is ``(doi, url, task, content_hash, classified_as,
    classification_method, classification_evidence, pos)``, one row per page and DOI;
    ``answers`` is ``(doi, agency, payload)``, one per DOI that resolved.
    """
    ref = json_object([
        ("url", quote(F.col("url"))), ("classified_as", quote(F.col("classified_as"))),
        ("classification_method", quote(F.col("classification_method"))),
        ("classification_evidence", quote(F.col("classification_evidence"))),
    ])
    gathered = sightings.join(pages.select("url", "page_order"), "url").groupBy("doi").agg(
        F.array_sort(F.collect_set("task")).alias("tasks"),
        F.array_sort(F.collect_set("content_hash")).alias("hashes"),
        F.transform(F.array_sort(F.array_distinct(F.collect_list(F.struct("page_order", ref.alias("ref"))))), lambda p: p["ref"]).alias("refs"),
    )
    body = json_object([
        ("doi", quote(F.col("doi"))), ("agency", quote(F.col("agency"))), ("resolution", F.col("payload")),
        ("task", F.to_json("tasks")), ("pages", json_array(F.col("refs"))),
    ])
    key = F.when(F.size("hashes") == 1, F.get("hashes", F.lit(0))).otherwise(payload_hash(F.to_json("hashes")))
    routes = F.when(F.size("tasks") > 0, F.transform("tasks", lambda t: F.concat(F.lit("task-page:"), t))).otherwise(
        F.array(F.lit("task-page:site")))
    return gathered.join(answers, "doi").select(
        F.col("doi").alias("source_id"), body.alias("payload"), stamp(key, MAPPING_VERSION).alias("source_key"),
        routes.alias("discovered_via"),
    )


@ob.register_mapper(SYSTEM)
def map_task_pages(
    raw: DataFrame, tasks: dict[str, str] | None = None, task_field: str = "task"
) -> tuple[DataFrame, DataFrame]:
    """``(observations, errors)``; an answer of an unknown registry is an error row."""
    rows = ob.with_doc(raw)
    doc = F.col("doc")
    rows = rows.withColumn("_agency", F.coalesce(ob.get(doc, "$.agency"), F.lit("")))
    known = F.col("_agency").isin("datacite", "crossref")
    errors = rows.filter(~known).select(
        "source_id", F.concat(F.lit("unknown resolver agency "), "_agency", F.lit(" for "), "source_id").alias("error"))
    answer = get_doc(doc, "$.resolution")
    a, b = datacite_fields(answer), crossref_fields(answer)
    is_datacite = F.col("_agency") == "datacite"
    rows = rows.filter(known).withColumns({f"f_{k}": F.when(is_datacite, a[k]).otherwise(b[k]) for k in a})
    f = lambda k: F.col(f"f_{k}")
    rows = rows.withColumn("_notes", tx.blank_to_null(sanitise_html(f("markup"))))
    doi = F.coalesce(tx.normalise_doi(ob.get(doc, "$.doi")), ob.get(doc, "$.doi"))
    landing = F.coalesce(f("url"), F.concat(F.lit("https://doi.org/"), doi))
    refs = ob.only_objects(get_list(doc, "$.pages"))
    seen = F.array_compact(F.transform(refs, lambda p: tx.blank_to_null(ob.get(p, "$.url"))))
    urls = F.concat(F.array(landing), F.filter(seen, lambda u: u != landing))
    named = F.array_sort(F.array_distinct(ob.known_tasks(
        F.transform(get_list(doc, "$.task"), lambda t: tx.normalise_task(F.try_variant_get(t, "$", "string"))), tasks)))
    how = lambda p, k: F.coalesce(quote(ob.get(p, f"$.{k}")), F.lit("null"))
    extra = json_object([
        ("resolved_by", quote(F.col("_agency"))), ("cited_on", F.to_json(seen)),
        ("identifier_source", quote(F.coalesce(ob.get(doc, "$.identifier_source"), F.lit("page-doi-sweep")))),
        ("page_classification", json_array(F.transform(refs, lambda p: json_object([
            ("url", how(p, "url")), ("classified_as", how(p, "classified_as")), ("method", how(p, "classification_method")),
            ("evidence", how(p, "classification_evidence"))])))),
        ("llm_influenced", F.exists(refs, lambda p: F.coalesce(
            ob.get(p, "$.classification_method") == "llm", F.lit(False))).cast("string")),
    ])
    fields = {
        "title": quote(f("title")), "notes": quote(F.col("_notes")), "doi": quote(doi), "url": quote(landing),
        "source_urls": ob.strings(urls), "authors": f("authors"), "publisher": quote(f("publisher")),
        "published_date": quote(f("published")), "version": quote(f("version")), "license_raw": quote(f("licence")),
        "license_id": quote(ob.mapped_licence(f("licence"))), "resource_kind": quote(f("kind")),
        "container": quote(f("container")), "keywords": f("keywords"), "related_identifiers": f("related"),
        task_field: ob.strings(named),
        "resources": json_array(F.array(json_object([
            ("name", F.lit('"DOI"')), ("url", quote(landing)), ("description", F.lit('"Resolved landing page"'))]))),
        "extra": extra,
    }
    api = ("title", "authors", "notes", "published_date", "publisher", "resource_kind")
    mapped = ob.observations(
        rows, SYSTEM, tx.identity_key(doi), doi,
        F.col("source_key") if "source_key" in raw.columns else stamp(payload_hash(F.col("payload")), MAPPING_VERSION),
        fields,
        {"doi": ("pattern", None), **{k: ("api", None) for k in api}, "license_id": ("pattern", None), task_field: ("pattern", None)},
    )
    # The page itself vouches for the identifier and the task, whoever scrapes later.
    own = lambda k, v: F.when(k.isin("doi", task_field), v.withField("source_system", F.lit(SYSTEM))).otherwise(v)
    return mapped.withColumn("provenance", F.transform_values("provenance", own)), errors
