"""Listing, facets, search pages and reader-facing fields of packages."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ledgerfold.functions import text as tx
from ledgerfold.functions.urls import host_of
from ledgerfold.operators.packages import extra, extra_list
from ledgerfold.operators.classify import lookup
from ledgerfold.session import checkpoint_folder
from ledgerfold.sources.registers import TYPE_KIND

PAGE_SIZE = 20
#: Pages that end within so many rows need no index.
EARLY_ROWS = 10_000
FACETS = ("task", "kind", "type", "year", "licence", "source", "institution", "availability")
MULTI_VALUED = ("task", "source")

# How access statuses group into availability.
AVAILABILITY = {
    "open": "open", "restricted": "restricted", "registration-required": "restricted",
    "embargoed": "embargoed", "metadata-only": "embargoed", "unknown": "unknown",
}
# Names of hosts and of source systems.
HOST_LABELS = {
    "zenodo.org": "Zenodo", "sandbox.zenodo.org": "Zenodo (sandbox)", "github.com": "GitHub",
    "osti.gov": "OSTI", "www.osti.gov": "OSTI", "wdh.energy.gov": "Wind Data Hub",
    "a2e.energy.gov": "Wind Data Hub", "doi.org": "doi.org", "dx.doi.org": "doi.org",
}
SOURCE_LABELS = {
    "zenodo": "Zenodo", "datacite": "DataCite", "crossref": "Crossref", "github": "GitHub",
    "osti": "OSTI", "wdh": "Wind Data Hub", "task_pages": "Task pages",
}
SYSTEM_HOSTS = {
    "zenodo": r"zenodo\.org", "github": r"github\.com", "osti": r"osti\.gov",
    "wdh": r"(wdh|a2e)\.energy\.gov", "crossref": r"doi\.org|crossref", "datacite": r"doi\.org|datacite",
}
EVENT_DESCRIPTIONS = {
    "scraped": "Upstream metadata observed and taken wholesale",
    "annotated": "Local annotation added",
    "withdrawn": "Artifact no longer available at the source",
    "displacement_notice": "A source value displaced a locally-added one",
    "pin_notice": "The page changed beneath a pinned extraction",
    "merge_proposal": "The reconciler found a probable duplicate — awaiting review, not merged",
}


def listed(packages: DataFrame) -> DataFrame:
    """Records that listings show: not merged away and not out of scope."""
    return packages.filter(
        (F.coalesce(extra("suppressed"), F.lit("")) != "true")
        & (F.coalesce(extra("inclusion_basis"), F.lit("direct")) != "none")
    )


def by_recency(rows: DataFrame, published: str = "published", seen: str = "last_seen", title: str = "title") -> list[Column]:
    """Sort keys: newest publication, newest sighting, then title as people sort it."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return [blank(published).desc(), blank(seen).desc(), F.collate(F.col(title), "UNICODE").asc()]


def author_names(key: str = "authors") -> Column:
    people = F.try_variant_get(F.try_parse_json(extra(key)), "$", "array<variant>")
    names = F.transform(people, lambda a: F.try_variant_get(a, "$.name", "string"))
    return F.coalesce(names, F.array().cast("array<string>"))


def author_summary(names: Column, limit: int = 3) -> Column:
    rest = F.size(names) - limit
    return F.when(rest <= 0, tx.english_list(names)).otherwise(
        F.concat(
            F.array_join(F.slice(names, 1, limit), ", "), F.lit(" and "), rest.cast("string"),
            F.when(rest == 1, " other").otherwise(" others"),
        )
    )


def citation(
    names: Column, year: Column, title: Column, version: Column, container: Column,
    publisher: Column, report_number: Column, doi: Column, source_url: Column,
) -> Column:
    none = F.lit("")
    people = (
        F.when(F.size(names) == 0, none)
        .when(F.size(names) > 5, F.concat(F.get(names, F.lit(0)), F.lit(" et al. ")))
        .otherwise(F.concat(F.array_join(names, "; "), F.lit(". ")))
    )
    part = lambda *cols: F.coalesce(F.concat(*cols), none)
    return F.trim(
        F.concat(
            people,
            F.when(F.coalesce(year, none) != "", F.concat(F.lit("("), year, F.lit("). "))).otherwise(none),
            title, part(F.lit(" (version "), version, F.lit(")")), F.lit("."),
            F.coalesce(F.concat(F.lit(" "), container, F.lit(".")), F.concat(F.lit(" "), publisher, F.lit(".")), none),
            part(F.lit(" "), report_number, F.lit(".")),
            F.coalesce(F.concat(F.lit(" https://doi.org/"), doi), F.concat(F.lit(" "), source_url), none),
        )
    )


def availability(status: Column) -> Column:
    return F.coalesce(lookup(AVAILABILITY, status), F.lit("unknown"))


def search_text(title: Column, names: Column, tasks: Column, doi: Column, notes: Column) -> Column:
    """Lower-case text a query's words are looked for in."""
    return F.lower(
        F.concat_ws(
            " ", F.coalesce(title, F.lit("")), F.array_join(names, " "), F.array_join(tasks, " "),
            F.coalesce(doi, F.lit("")), tx.plain_text(notes),
        )
    )


def listing_rows(packages: DataFrame, task_field: str = "task") -> DataFrame:
    """One narrow row per package with its facet values and search text."""
    systems = extra_list("source_systems")
    single = extra("source_system")
    tasks = extra_list(task_field)
    rtype = extra("resource_type")
    one = lambda value: F.array(F.coalesce(value, F.lit("")))
    published = extra("published_date")
    return packages.select(
        "name", "title",
        F.coalesce(published, F.lit("")).alias("published"),
        F.coalesce(extra("last_seen"), F.lit("")).alias("last_seen"),
        tasks.alias("task"),
        one(F.coalesce(lookup(TYPE_KIND, rtype), extra("resource_kind"))).alias("kind"),
        one(rtype).alias("type"),
        one(F.substring(published, 1, 4)).alias("year"),
        one(F.col("license_id")).alias("licence"),
        F.when(F.size(systems) > 0, systems).when(single.isNotNull(), F.array(single))
        .otherwise(F.array().cast("array<string>")).alias("source"),
        one(F.col("owner_org")).alias("institution"),
        one(availability(extra("access_status"))).alias("availability"),
        search_text(F.col("title"), author_names(), tasks, extra("doi"), F.col("notes")).alias("text"),
    )


@dataclass(frozen=True)
class SearchQuery:
    """What a reader asks: values chosen per facet, words, and a page."""

    selections: dict[str, list[str]] = field(default_factory=dict)
    q: str = ""
    page: int = 1
    page_size: int = PAGE_SIZE

    @property
    def tokens(self) -> list[str]:
        return self.q.strip().lower().split()


def facet_match(name: str, query: SearchQuery) -> Column:
    """OR inside a facet; a facet nobody chose matches everything."""
    chosen = query.selections.get(name) or []
    if not chosen:
        return F.lit(True)
    return F.coalesce(F.arrays_overlap(F.col(name), F.array(*[F.lit(c) for c in chosen])), F.lit(False))


def text_match(query: SearchQuery) -> Column:
    hit = F.lit(True)
    for token in query.tokens:
        hit = hit & F.col("text").contains(token)
    return hit


def matches(query: SearchQuery, facets: tuple[str, ...] = FACETS) -> Column:
    """AND across facets and words."""
    hit = text_match(query)
    for name in facets:
        hit = hit & facet_match(name, query)
    return hit


def facet_values(rows: DataFrame, facets: tuple[str, ...] = FACETS) -> DataFrame:
    """``(facet, value)`` per listed value; empty values are left out, repeats stay."""
    def pairs_of(name: str) -> Column:
        return F.transform(F.col(name), lambda v: F.struct(F.lit(name).alias("facet"), v.alias("value")))

    pairs = F.flatten(F.array(*[pairs_of(f) for f in facets]))
    return rows.select(F.explode(pairs).alias("p")).select("p.*").filter(F.coalesce("value", F.lit("")) != "")


def facet_counts(rows: DataFrame, facets: tuple[str, ...] = FACETS) -> DataFrame:
    """``(facet, value, n)``; order by n descending, then label, to show them."""
    return facet_values(rows, facets).groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


def sideways_counts(rows: DataFrame, query: SearchQuery, facets: tuple[str, ...] = FACETS) -> DataFrame:
    """Each facet counted under the words and all other facets' choices, in one pass.

    Every value keeps a row, at zero when nothing is left.
    """
    hits = {f: facet_match(f, query) for f in facets}
    text = text_match(query)

    def others(name: str) -> Column:
        hit = text
        for f in facets:
            if f != name:
                hit = hit & hits[f]
        return hit

    def pairs_of(name: str) -> Column:
        return F.transform(
            F.array_distinct(F.col(name)),
            lambda v: F.struct(F.lit(name).alias("facet"), v.alias("value"), others(name).alias("hit")),
        )

    pairs = F.flatten(F.array(*[pairs_of(f) for f in facets]))
    return (
        rows.select(F.explode(pairs).alias("p")).select("p.*")
        .filter(F.coalesce("value", F.lit("")) != "")
        .groupBy("facet", "value")
        .agg(F.count(F.when(F.col("hit"), 1)).alias("n"))
    )


@dataclass(frozen=True)
class PageIndex:
    """Results in order, stored in ranges of the sort key, and how many rows come before each range."""

    spark: SparkSession
    path: str
    order: list[Column]
    starts: list[tuple[int, int, int]]  # range, rows before it, rows in it

    @property
    def total(self) -> int:
        return sum(n for _, _, n in self.starts)

    def rows(self, first: int, size: int) -> DataFrame:
        """``size`` results from the place ``first`` on, from the ranges that hold them and no others."""
        met = [(p, at) for p, at, n in self.starts if at < first + size and first < at + n] or [(-1, first)]
        found = self.spark.read.parquet(self.path).filter(F.col("_range").isin([p for p, _ in met])).drop("_range")
        return found.orderBy(*self.order).offset(first - met[0][1]).limit(size)


def indexed_pages(found: DataFrame, order: list[Column], ranges: int | None = None) -> PageIndex:
    """Sort results once, by ranges whose borders are sampled, so every page after that reads what it shows and no more.
    ``order`` should tell all rows apart."""
    spark = found.sparkSession
    path = f"{checkpoint_folder(spark)}/pages-{uuid.uuid4().hex}"
    dealt = found.repartitionByRange(ranges, *order) if ranges else found.repartitionByRange(*order)
    dealt.withColumn("_range", F.spark_partition_id()).write.partitionBy("_range").parquet(path)
    stored = spark.read.schema(StructType([*found.schema.fields, StructField("_range", IntegerType())])).parquet(path)
    counts = sorted(stored.groupBy("_range").count().collect())  # one row per range
    ends = list(accumulate(r["count"] for r in counts))
    return PageIndex(spark, path, order, [(r["_range"], end - r["count"], r["count"]) for r, end in zip(counts, ends, strict=True)])


def page_start(total: int, query: SearchQuery) -> int:
    """Where a page begins. A page past the end is the last page."""
    pages = max(1, -(-total // query.page_size))
    return (min(max(1, query.page), pages) - 1) * query.page_size


def result_page(found: DataFrame, query: SearchQuery, order: list[Column], total: int | None = None) -> DataFrame:
    """One page of results.

    Of an early page only the rows up to it are kept by each task, then the page is cut. A later one is read from
    an index, since all rows before it would come to one place.
    """
    first = page_start(found.count() if total is None else total, query)
    if first + query.page_size <= EARLY_ROWS:
        return found.orderBy(*order).offset(first).limit(query.page_size)
    return indexed_pages(found, order).rows(first, query.page_size)


def search(rows: DataFrame, query: SearchQuery) -> tuple[DataFrame, DataFrame, int]:
    """``(page, facet counts, total)`` for a query over listing rows."""
    found = rows.filter(matches(query))
    total = found.count()
    order = [*by_recency(rows), F.col("name")]
    return result_page(found, query, order, total), sideways_counts(rows, query), total


def kind_counts(rows: DataFrame, labels: DataFrame, kind: str = "kind") -> DataFrame:
    """``(kind, n, text)`` with the written-out plural: ``3 reports``, ``1 dataset``."""
    counted = rows.groupBy(kind).agg(F.count(F.lit(1)).alias("n"))
    names = labels.select(F.col("name").alias(kind), "label", "plural")
    singular = F.lower(F.coalesce("label", kind))
    return counted.join(names, kind, "left").select(
        kind, "n",
        F.concat(F.col("n").cast("string"), F.lit(" "),
                 F.when(F.col("n") == 1, singular).otherwise(F.coalesce("plural", F.concat(singular, F.lit("s"))))).alias("text"),
    )


def first_hosts(rows: DataFrame, key: str, urls: str) -> DataFrame:
    """``(key, pos, host, url, label)``: distinct hosts of a row's URLs, first URL each."""
    spread = rows.select(key, F.posexplode(urls).alias("pos", "url")).withColumn("host", host_of(F.col("url")))
    first = (
        spread.filter(F.col("host") != "")
        .groupBy(key, "host").agg(F.min(F.struct("pos", "url")).alias("u"))
    )
    label = F.coalesce(lookup(HOST_LABELS, F.col("host")), F.regexp_replace("host", r"^www\.", ""))
    return first.select(key, "u.pos", "host", "u.url", label.alias("label"))


def package_hosts(packages: DataFrame) -> DataFrame:
    """Where a record lives: its DOI first, then its pages."""
    doi = extra("doi")
    urls = F.array_compact(
        F.concat(
            F.array(F.concat(F.lit("https://doi.org/"), doi), F.col("url"), extra("source_url")),
            extra_list("source_urls"),
        )
    )
    return first_hosts(packages.select("name", urls.alias("urls")), "name", "urls")


def outbound_urls(packages: DataFrame) -> DataFrame:
    """``(name, pos, url)``: every http(s) address of a record, once, in order."""
    links = F.try_variant_get(F.try_parse_json(extra("local_links")), "$", "array<variant>")
    linked = F.transform(
        F.coalesce(links, F.array().cast("array<variant>")),
        lambda e: F.coalesce(F.try_variant_get(e, "$.url", "string"),
                             F.when(~F.to_json(e).startswith("{"), F.try_variant_get(e, "$", "string"))),
    )
    every = F.concat(
        F.array("url", extra("source_url")), extra_list("source_urls"), linked,
        F.transform("resources", lambda r: r["url"]),
    )
    kept = F.array_distinct(F.filter(every, lambda u: u.rlike(r"^https?://")))
    return packages.select("name", F.posexplode(kept).alias("pos", "url"))


def inferred_fields(provenance: Column) -> Column:
    """Names of the fields a model inferred, from the provenance extra's JSON."""
    entries = F.from_json(provenance, "map<string,struct<extraction_method:string>>")
    return F.array_sort(
        F.map_keys(F.map_filter(entries, lambda _, p: F.coalesce(p["extraction_method"] == "llm", F.lit(False))))
    )


def is_retracted(related: Column) -> Column:
    """Whether a stated relation says the work is retracted; ``related`` is JSON."""
    items = F.try_variant_get(F.try_parse_json(related), "$", "array<variant>")
    return F.coalesce(
        F.exists(items, lambda r: F.coalesce(F.try_variant_get(r, "$.relation", "string").rlike("(?i)retract"), F.lit(False))),
        F.lit(False),
    )


def report_issue_url(system: Column, urls: Column, source_url: Column) -> Column:
    """Where to report a metadata problem: the address at the system asked about."""
    pattern = lookup(SYSTEM_HOSTS, system)
    own = F.get(F.filter(urls, lambda u: F.regexp_like(u, pattern)), F.lit(0))
    url = F.coalesce(own, source_url)
    return F.when(system == "github", F.concat(F.regexp_replace(url, r"/$", ""), F.lit("/issues"))).otherwise(url)


def merged_target(links: Column) -> Column:
    """``STRUCT<url, label>`` of the record this one was merged into; links is JSON."""
    items = F.from_json(links, "array<struct<url:string,label:string>>")
    hit = F.get(F.filter(items, lambda l: l["label"].startswith("Catalogued as ")), F.lit(0))
    return F.when(
        hit.isNotNull(),
        F.struct(hit["url"].alias("url"), F.regexp_replace(hit["label"], r"^Catalogued as ", "").alias("label")),
    )


def event_history(events: DataFrame, problems: DataFrame | None = None) -> DataFrame:
    """``(identity_key, observed_at, seq, event_type, description, ...)`` for a record's
    audit trail; lines nobody could read show as ``unreadable``."""
    rows = events.select(
        "identity_key", "observed_at", "seq", "event_type",
        F.coalesce(lookup(EVENT_DESCRIPTIONS, F.col("event_type")), F.col("event_type")).alias("description"),
        "source_system", "actor", "note", "source_key",
    )
    if problems is None:
        return rows
    return rows.unionByName(
        problems.select(
            F.lit(None).cast("string").alias("identity_key"), F.lit("").alias("observed_at"),
            F.col("line").alias("seq"), F.lit("unreadable").alias("event_type"),
            F.lit("unreadable").alias("description"), F.col("message").alias("note"),
        ),
        allowMissingColumns=True,
    )


def record_details(packages: DataFrame, dead: DataFrame, history: DataFrame) -> DataFrame:
    """A record's page: its package, dead links, event history and merge target.

    ``dead`` is ``(name, urls)``; ``history`` the rows of :func:`event_history`. The
    page shows a whole history, so its rows are nested here and nowhere else.
    """
    trail = history.groupBy("identity_key").agg(
        F.array_sort(F.collect_list(F.struct("observed_at", "seq", "event_type", "description", "source_system",
                                             "actor", "note", "source_key"))).alias("history")
    )
    return (
        packages.join(dead.withColumnRenamed("urls", "dead_links"), "name", "left")
        .join(trail, "identity_key", "left")
        .withColumn("merged_into", merged_target(extra("local_links")))
        .withColumn("out_of_scope", F.coalesce(extra("inclusion_basis"), F.lit("direct")) == "none")
    )
