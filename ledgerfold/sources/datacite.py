"""DataCite DOIs to observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions import text as tx
from ledgerfold.functions.html import sanitise_each
from ledgerfold.functions.jsonval import get_doc, json_array, json_object, json_type, let, quote
from ledgerfold.operators.changes import stamp
from ledgerfold.operators.classify import lookup
from ledgerfold.sources import observation as ob

MAPPING_VERSION = 2

# DataCite's general types, hints in free text, and access terms.
KINDS = {
    "dataset": "dataset", "software": "software", "computationalnotebook": "software",
    "workflow": "software", "model": "model", "report": "report", "outputmanagementplan": "report",
    "text": "publication", "journalarticle": "publication", "conferencepaper": "publication",
    "conferenceproceeding": "publication", "book": "publication", "bookchapter": "publication",
    "dissertation": "publication", "preprint": "publication", "peerreview": "publication",
    "datapaper": "publication", "standard": "publication", "audiovisual": "other", "award": "other",
    "collection": "other", "event": "other", "image": "other", "instrument": "other",
    "interactiveresource": "other", "physicalobject": "other", "project": "other",
    "service": "other", "sound": "other",
}
HINTS = (
    ("computationalnotebook", "software"), ("sourcecode", "software"), ("source code", "software"),
    ("software", "software"), ("technical report", "report"), ("deliverable", "report"),
    ("report", "report"), ("journal article", "publication"), ("journalarticle", "publication"),
    ("scholarlyarticle", "publication"), ("conference", "publication"),
    ("proceedings", "publication"), ("dissertation", "publication"), ("thesis", "publication"),
    ("preprint", "publication"), ("presentation", "publication"), ("poster", "publication"),
    ("article", "publication"), ("paper", "publication"), ("database", "dataset"),
    ("data set", "dataset"), ("dataset", "dataset"), ("model", "model"),
)
ACCESS = {
    "openaccess": "open", "closedaccess": "restricted", "restrictedaccess": "restricted",
    "embargoedaccess": "embargoed",
}


def source_key(attributes: Column) -> Column:
    """The update stamp at second precision, whichever endpoint spelled it."""
    raw = ob.stripped(attributes, "$.updated")
    whole = F.regexp_replace(F.regexp_replace(raw, r"Z$", ""), r"\..*$", "")
    return stamp(F.when(raw.endswith("Z"), F.concat(whole, F.lit("Z"))).otherwise(whole), MAPPING_VERSION)


def kind_of(types: Column) -> Column:
    """``STRUCT<kind, method>``: the general type, else a hint in the free text."""
    general = F.lower(ob.stripped(types, "$.resourceTypeGeneral"))
    free = F.lower(F.concat_ws(" ", ob.get(types, "$.resourceType"), ob.get(types, "$.schemaOrg")))
    pick = lambda kind, method: F.struct(kind.alias("kind"), F.lit(method).alias("method"))
    found = F.when(lookup(KINDS, general).isNotNull(), pick(lookup(KINDS, general), "api"))
    for needle, kind in HINTS:
        found = found.when(free.contains(needle), pick(F.lit(kind), "pattern"))
    return found.otherwise(pick(F.lit("other"), "api"))


def licence_of(attributes: Column) -> Column:
    """``STRUCT<raw, id>``: the first rights text that maps, entry by entry."""
    entries = ob.only_objects(ob.as_list(get_doc(attributes, "$.rightsList")))
    texts = F.array_compact(F.flatten(F.transform(
        entries, lambda e: F.array(*[first for first in (
            ob.first_string(get_doc(e, f"$.{k}")) for k in ("rightsIdentifier", "rights", "rightsUri"))]))))
    judged = F.transform(texts, lambda t: F.struct(t.alias("raw"), ob.licence_id(t).alias("id")))
    hit = F.get(F.filter(judged, lambda j: j["id"].isNotNull() & (j["id"] != "notspecified")), F.lit(0))
    return let(hit, lambda h: F.struct(
        F.coalesce(h["raw"], F.get(texts, F.lit(0))).alias("raw"),
        F.coalesce(h["id"], F.lit("notspecified")).alias("id")))


def access_of(attributes: Column) -> Column:
    entries = ob.only_objects(ob.as_list(get_doc(attributes, "$.rightsList")))
    terms = F.flatten(F.transform(entries, lambda e: F.array(
        *[F.lower(F.trim(ob.get(e, f"$.{k}"))) for k in ("rights", "rightsUri")])))
    stated = F.filter(terms, lambda t: t.contains("info:eu-repo/semantics/"))
    return ob.first_of(F.transform(stated, lambda t: lookup(ACCESS, F.substring_index(t, "/", -1))))


def authors_of(attributes: Column) -> Column:
    def build(c: Column):
        part = lambda k: ob.first_string(get_doc(c, f"$.{k}"))
        ids = F.filter(
            ob.only_objects(ob.as_list(get_doc(c, "$.nameIdentifiers"))),
            lambda i: (F.upper(ob.get(i, "$.nameIdentifierScheme")) == "ORCID") & ob.stripped(i, "$.nameIdentifier").isNotNull(),
        )
        orcid = F.substring_index(ob.stripped(F.get(ids, F.lit(0)), "$.nameIdentifier"), "/", -1)
        places = F.transform(ob.as_list(get_doc(c, "$.affiliation")), ob.first_string)
        return [("name", quote(_name(c))), ("given", quote(part("givenName"))), ("family", quote(part("familyName"))),
                ("orcid", quote(orcid)), ("affiliation", quote(ob.first_of(places)))]

    return ob.objects(ob.only_objects(ob.as_list(get_doc(attributes, "$.creators"))), build,
                      lambda c: _name(c).isNotNull())


def _name(c: Column) -> Column:
    part = lambda k: ob.first_string(get_doc(c, f"$.{k}"))
    return F.coalesce(part("name"), tx.blank_to_null(F.concat_ws(", ", part("familyName"), part("givenName"))))


def titles_of(attributes: Column) -> Column:
    """``STRUCT<title, others>``: the untyped title first; the rest as JSON objects."""
    listed = F.filter(
        F.transform(
            ob.only_objects(ob.as_list(get_doc(attributes, "$.titles"))),
            lambda t: F.struct(*[ob.first_string(get_doc(t, f"$.{k}")).alias(a) for k, a in (
                ("title", "title"), ("titleType", "kind"), ("lang", "lang"))]),
        ),
        lambda t: t["title"].isNotNull(),
    )

    def split(items: Column) -> Column:
        free = F.array_position(F.transform(items, lambda t: t["kind"].isNull()), True)
        at = F.when(free > 0, free).otherwise(F.when(F.size(items) > 0, F.lit(1)))
        rest = F.filter(items, lambda t, i: i + 1 != F.coalesce(at, F.lit(0)))
        return F.struct(
            F.get(items, (at - 1).cast("int"))["title"].alias("title"),
            F.transform(rest, lambda t: json_object(
                [("title", quote(t["title"])), ("title_type", quote(t["kind"])), ("lang", quote(t["lang"]))])).alias("others"),
            F.transform(rest, lambda t: t["title"]).alias("other_titles"),
        )

    return let(listed, split)


@ob.register_mapper("datacite")
def map_datacite(raw: DataFrame, task_pattern: str | None = None, task_field: str = "task") -> DataFrame:
    """``task_pattern`` finds task mentions (one or two number groups); they stay
    candidates, since a projection cannot ask the register."""
    rows = ob.with_doc(raw)
    rows = rows.withColumn("att", F.coalesce(get_doc(F.col("doc"), "$.attributes"), F.col("doc")))
    doc, att = F.col("doc"), F.col("att")
    described = F.filter(
        F.transform(
            ob.only_objects(ob.as_list(get_doc(att, "$.descriptions"))),
            lambda d: F.struct(ob.first_string(get_doc(d, "$.description")).alias("text"),
                               ob.first_string(get_doc(d, "$.descriptionType")).alias("kind")),
        ),
        lambda d: d["text"].isNotNull(),
    )
    rows = rows.withColumn("_desc", described).withColumn(
        "_clean", sanitise_each(F.transform("_desc", lambda d: d["text"]))
    )
    abstract = F.array_position(F.transform("_desc", lambda d: F.coalesce(d["kind"], F.lit(""))), "Abstract")
    main = F.when(abstract > 0, abstract).otherwise(1).cast("int")
    rows = rows.withColumns(
        {
            "_notes": F.when(F.size("_desc") > 0, F.get(F.col("_clean"), main - 1)),
            "_title": titles_of(att), "_licence": licence_of(att), "_kind": kind_of(get_doc(att, "$.types")),
            "_doi": tx.normalise_doi(F.coalesce(tx.blank_to_null(ob.get(att, "$.doi")), ob.get(doc, "$.id"))),
        }
    )
    title, notes, doi = F.col("_title.title"), F.col("_notes"), F.col("_doi")
    others = F.filter(
        F.transform(F.arrays_zip(F.col("_desc").alias("d"), F.col("_clean").alias("c")), lambda z, i: F.when(
            i + 1 != main, json_object([("description", quote(z["c"])), ("description_type", quote(z["d"]["kind"]))]))),
        lambda x: x.isNotNull(),
    )
    publisher_doc = get_doc(att, "$.publisher")
    publisher = ob.first_string(publisher_doc)
    landing = F.coalesce(ob.first_string(get_doc(att, "$.url")), F.col("url"))
    subjects = F.transform(ob.as_list(get_doc(att, "$.subjects")), lambda s: ob.first_string(
        F.coalesce(F.when(json_type(s) == "OBJECT", get_doc(s, "$.subject")), F.when(json_type(s) != "OBJECT", s))))
    words = F.array_distinct(F.array_compact(subjects))
    related = F.array_distinct(F.transform(
        F.filter(ob.only_objects(ob.as_list(get_doc(att, "$.relatedIdentifiers"))),
                 lambda e: ob.first_string(get_doc(e, "$.relatedIdentifier")).isNotNull()),
        lambda e: json_object([
            ("identifier", quote(F.coalesce(
                F.when(F.upper(ob.stripped(e, "$.relatedIdentifierType")) == "DOI",
                       tx.normalise_doi(ob.get(e, "$.relatedIdentifier"))),
                ob.first_string(get_doc(e, "$.relatedIdentifier"))))),
            ("identifier_type", quote(ob.first_string(get_doc(e, "$.relatedIdentifierType")))),
            ("relation", quote(ob.first_string(get_doc(e, "$.relationType"))))]),
    ))
    issued = F.filter(
        F.transform(
            F.filter(ob.only_objects(ob.as_list(get_doc(att, "$.dates"))),
                     lambda d: F.lower(F.trim(ob.get(d, "$.dateType"))) == "issued"),
            lambda d: ob.first_string(get_doc(d, "$.date"))),
        lambda d: d.isNotNull(),
    )
    longest = F.aggregate(issued, F.lit(None).cast("string"), lambda a, d: F.when(
        a.isNull() | (F.length(d) > F.length(a)), d).otherwise(a))
    year = F.when(ob.get(att, "$.publicationYear") != "0", ob.stripped(att, "$.publicationYear"))
    published = F.coalesce(longest, year)
    resources = F.array_distinct(F.array_compact(F.transform(ob.as_list(get_doc(att, "$.contentUrl")), ob.first_string)))
    resources_json = json_array(F.transform(resources, lambda u: json_object([("url", quote(u))])))
    container = get_doc(att, "$.container")
    container_title = F.when(json_type(container) == "OBJECT", ob.first_string(get_doc(container, "$.title")))
    candidates = F.array().cast("array<string>")
    if task_pattern:
        texts = F.concat(F.array(publisher, title, notes), F.col("_title.other_titles"),
                         F.transform(ob.only_objects(ob.as_list(get_doc(att, "$.subjects"))),
                                     lambda s: ob.first_string(get_doc(s, "$.subject"))))
        candidates = F.array_sort(F.array_distinct(F.flatten(F.transform(
            F.array_compact(texts), lambda t: tx.task_mentions(t, task_pattern, 2)))))
    filled = lambda arr, js: F.when(F.size(arr) > 0, js)
    extra = json_object([
        ("datacite_state", ob.raw_json(att, "$.state")),
        ("datacite_client_id", ob.raw_json(doc, "$.relationships.client.data.id")),
        ("datacite_schema_version", ob.raw_json(att, "$.schemaVersion")),
        ("datacite_types", ob.raw_json(att, "$.types")),
        ("datacite_publisher", F.when(json_type(publisher_doc) == "OBJECT", F.to_json(publisher_doc))),
        ("datacite_container", F.when(json_type(container) == "OBJECT", ob.raw_json(att, "$.container"))),
        ("datacite_identifiers", ob.raw_json(att, "$.identifiers")),
        ("rights_list", ob.raw_json(att, "$.rightsList")),
        ("alternate_titles", filled(F.col("_title.others"), json_array(F.col("_title.others")))),
        ("other_descriptions", filled(others, json_array(others))),
        (f"{task_field}_candidates", filled(candidates, F.to_json(candidates))),
    ])
    access = access_of(att)
    authors = authors_of(att)
    version = ob.first_string(get_doc(att, "$.version"))
    fields = {
        "title": quote(title), "notes": quote(notes), "doi": quote(doi), "url": quote(landing),
        "source_urls": ob.strings(F.array_compact(F.array(landing))), "authors": authors, "publisher": quote(publisher),
        "published_date": quote(published), "version": quote(version), "license_raw": quote(F.col("_licence.raw")),
        "license_id": quote(F.col("_licence.id")), "resource_kind": quote(F.col("_kind.kind")),
        "access_status": quote(access), "container": quote(container_title), "keywords": ob.strings(words),
        "resources": resources_json, "related_identifiers": json_array(related), task_field: F.lit("[]"),
        "withdrawn": (F.coalesce(F.to_json(get_doc(att, "$.isActive")), F.lit("")) == "false").cast("string"), "extra": extra,
    }
    some = {
        "title": title.isNotNull(), "notes": notes.isNotNull(), "doi": doi.isNotNull(), "authors": authors != "[]",
        "publisher": publisher.isNotNull(), "published_date": published.isNotNull(), "version": version.isNotNull(),
        "container": container_title.isNotNull(), "keywords": F.size(words) > 0,
        "related_identifiers": F.size(related) > 0, "resources": F.size(resources) > 0,
    }
    return ob.observations(
        rows, "datacite", tx.identity_key(doi, F.lit("datacite"), F.col("source_id"), title),
        F.coalesce(tx.normalise_doi(F.col("source_id")), F.col("source_id")), source_key(att), fields,
        {
            **{k: ("api", v) for k, v in some.items()}, "license_id": ("pattern", None),
            "resource_kind": (F.col("_kind.method"), None), "access_status": ("pattern", access.isNotNull()),
        },
    )
