"""From raw payload rows to the observations worth mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerfold.functions import text as tx
from ledgerfold.functions.jsonval import get_doc, get_text, json_type
from ledgerfold.operators.skew import lookup_join

BADGE_MARKER = "zenodo.org/badge"
IMAGE_SUFFIX = r"(?i)\.(svg|png|jpe?g|gif)$"
MARKUP = r"""[\s()\[\]<>"'`|,]+"""
META_REPOSITORIES = (".github", ".github-private")
AGENCY_RANK = {"datacite": 0, "crossref": 1}


def first_route(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per artifact, from the first route that found it."""
    rest = [c for c in rows.columns if c not in key]
    return (
        rows.groupBy(*key)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"))
        .select(*key, "r.*")
    )


def all_routes(rows: DataFrame, key: list[str], route: str, order: list[str]) -> DataFrame:
    """``(key, discovered_via)``: every route that found an artifact, first seen first."""
    firsts = rows.groupBy(*key, route).agg(F.min(F.struct(*order)).alias("_at"))
    return firsts.groupBy(*key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_at", route))), lambda r: r[route]).alias(
            "discovered_via"
        )
    )


def cap_per_source(rows: DataFrame, source: str, order: list[str], limit: int) -> tuple[DataFrame, DataFrame]:
    """``(kept, cut)``: the first ``limit`` rows of each source, the crawl budget that the caller
    gives a run, and those that wait.

    The rank filter runs on every map task before the shuffle, so a source that owns
    most of the rows sends ``limit`` of them per task. ``order`` must tell rows of a source apart: the
    rows after the last one kept are those that wait, found without ranking them.
    """
    rank = F.row_number().over(W.partitionBy(source).orderBy(*order))
    kept = rows.withColumn("_rank", rank).filter(F.col("_rank") <= limit)
    place = F.struct(*order)
    last = kept.groupBy(F.col(source).alias("_source")).agg(F.max(place).alias("_last"))
    cut = rows.join(last, F.col(source).eqNullSafe(F.col("_source"))).filter(place > F.col("_last"))
    return kept.drop("_rank"), cut.drop("_source", "_last")


def split_state(rows: DataFrame, state: Column, required: str = "findable") -> tuple[DataFrame, DataFrame]:
    """``(kept, skipped)`` by registration state; what is skipped is reported."""
    ok = F.coalesce(F.lower(tx.strip(state)) == required, F.lit(False))
    skipped = rows.filter(~ok).withColumn("reason", F.concat(F.lit("state is "), F.coalesce(state, F.lit("(absent)"))))
    return rows.filter(ok), skipped


def readme_text(payload: Column) -> Column:
    """The README of a repository payload, decoded; empty when there is none."""
    content = get_text(payload, "$.readme.content")
    encoding = F.lower(F.coalesce(tx.blank_to_null(get_text(payload, "$.readme.encoding")), F.lit("base64")))
    plain = F.try_to_binary(F.regexp_replace(content, r"\s", ""), F.lit("base64"))
    return F.coalesce(
        F.when(encoding != "base64", content).otherwise(F.try_validate_utf8(plain.cast("string"))), F.lit("")
    )


def content_bytes(payload: Column) -> Column:
    return F.coalesce(F.try_variant_get(payload, "$.repository.size", "bigint"), F.lit(0)) * 1024


def exclusion_reason(payload: Column, exclude_forks: bool = True, min_bytes: int = 2048) -> Column:
    """Why a repository is noise; NULL when it belongs. Archived ones belong."""
    flag = lambda p: F.coalesce(F.try_variant_get(payload, p, "boolean"), F.lit(False))
    size = content_bytes(payload)
    description = tx.strip(F.coalesce(get_text(payload, "$.repository.description"), F.lit("")))
    return (
        F.when(F.lit(exclude_forks) & flag("$.repository.fork"), "fork")
        .when(flag("$.repository.is_template"), "template repository")
        .when(get_text(payload, "$.repository.name").isin(*META_REPOSITORIES),
              "GitHub meta-repository, not an artifact")
        .when(size < min_bytes,
              F.concat(F.lit("below the content threshold ("), size.cast("string"), F.lit(f" < {min_bytes} bytes)")))
        .when((description == "") & (readme_text(payload) == ""), "no description and no README")
    )


def first_seen_ids(scrapes: DataFrame, stable_id: str, source_id: str, order: list[str]) -> DataFrame:
    """``(stable_id, source_id)``: the name a rename-proof id was first seen under."""
    known = scrapes.filter(F.col(stable_id).isNotNull() & (F.coalesce(source_id, F.lit("")) != ""))
    return known.groupBy(stable_id).agg(F.min_by(source_id, F.struct(*order)).alias(source_id))


def keep_first_names(rows: DataFrame, known: DataFrame, stable_id: str, source_id: str) -> DataFrame:
    """Rows under the name their id was first seen by."""
    old = known.withColumnRenamed(source_id, "_first")
    return lookup_join(rows, old, [stable_id], "left").withColumn(source_id, F.coalesce("_first", source_id)).drop("_first")


def prefer_published(
    rows: DataFrame, own: str, published: str, resolvable: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """``(kept, dropped)``: a preprint yields to its published version.

    It is dropped when that version is in the batch, kept when the version is
    elsewhere but resolves, and dropped when it does not resolve.
    """
    here = rows.select(F.col(own).alias(published)).distinct().withColumn("_here", F.lit(True))
    there = resolvable.select(F.col(resolvable.columns[0]).alias(published)).distinct().withColumn("_there", F.lit(True))
    # Most works are no preprint; only those that are meet the joins.
    preprints = rows.filter(F.col(published).isNotNull())
    judged = preprints.join(here, published, "left").join(there, published, "left").withColumn(
        "reason",
        F.when(F.col("_here"), "published version is in this batch")
        .when(F.col("_there").isNull(), "asserted published version did not resolve"),
    ).drop("_here", "_there")
    kept = judged.filter(F.col("reason").isNull()).drop("reason")
    kept = kept.unionByName(rows.filter(F.col(published).isNull()))
    return kept, judged.filter(F.col("reason").isNotNull())


def resolve_or_drop(dois: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(resolved, drops)`` for ``(raw, context)`` against registry answers.

    ``answers`` is ``(doi, agency, status, payload)``; status 200 resolves, and the
    first registry in rank order answers for a DOI.
    """
    ranks = F.create_map(*[F.lit(x) for kv in AGENCY_RANK.items() for x in kv])
    best = (
        answers.filter(F.col("status") == 200)
        .groupBy("doi")
        .agg(F.min_by(F.struct("agency", "payload"), F.coalesce(F.element_at(ranks, F.col("agency")), F.lit(9))).alias("a"))
        .select("doi", "a.agency", "a.payload")
    )
    asked = dois.withColumn("doi", tx.normalise_doi(F.col("raw")))
    joined = lookup_join(asked, best, ["doi"], "left")
    kept = joined.filter(F.col("agency").isNotNull())
    drops = joined.filter(F.col("agency").isNull()).select(
        F.coalesce("doi", "raw").alias("doi"),
        F.when(F.col("doi").isNull(), "malformed").otherwise("did-not-resolve").alias("reason"),
        "context",
    )
    return kept, drops


def badge_candidates(readmes: DataFrame, key: str) -> DataFrame:
    """``(key, pos, doi)``: DOIs on the lines that show a badge, image endings removed.

    A DOI a README merely cites is on another line and is no claim about the
    repository.
    """
    lines = readmes.select(key, F.posexplode(F.split("readme", r"\r\n|[\n\r]")).alias("line_no", "line")).filter(
        F.lower("line").contains(BADGE_MARKER)
    )
    tokens = lines.select(key, "line_no", F.posexplode(F.split("line", MARKUP)).alias("token_no", "token"))
    found = tokens.select(
        key, "line_no", "token_no", F.posexplode(tx.extract_dois(F.col("token"))).alias("n", "raw")
    ).withColumn("doi", tx.normalise_doi(F.regexp_replace("raw", IMAGE_SUFFIX, "")))
    return (
        found.filter(F.col("doi").isNotNull())
        .groupBy(key, "doi").agg(F.min(F.struct("line_no", "token_no", "n")).alias("pos"))
    )


def concept_doi(payload: Column) -> Column:
    """The concept DOI a registry payload of a version declares."""
    related = F.try_variant_get(payload, "$.data.attributes.relatedIdentifiers", "array<variant>")
    low = lambda r, p: F.lower(F.try_variant_get(r, p, "string"))
    hits = F.filter(
        related,
        lambda r: (low(r, "$.relationType") == "isversionof") & (low(r, "$.relatedIdentifierType") == "doi"),
    )
    dois = F.array_compact(
        F.transform(hits, lambda r: tx.normalise_doi(F.try_variant_get(r, "$.relatedIdentifier", "string")))
    )
    return F.get(dois, F.lit(0))


def resolve_badges(candidates: DataFrame, answers: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``(key, doi, version_doi)`` from the first badge that resolves, the concept DOI it
    declares preferred when that resolves too; and the drops."""
    kept, drops = resolve_or_drop(
        candidates.withColumn("raw", F.col("doi")).withColumn("context", F.col(key).cast("string")).drop("doi"),
        answers,
    )
    first = kept.groupBy(key).agg(F.min_by(F.struct("doi", "payload"), "pos").alias("f")).select(key, "f.*")
    declared = first.withColumn("concept", concept_doi(F.try_parse_json("payload")))
    good = answers.filter(F.col("status") == 200).select(F.col("doi").alias("concept")).distinct().withColumn("_ok", F.lit(True))
    judged = declared.join(good, "concept", "left")
    better = F.col("_ok") & (F.col("concept") != F.col("doi"))
    settled = judged.select(
        key, F.when(better, F.col("concept")).otherwise(F.col("doi")).alias("doi"),
        F.when(better, F.col("doi")).alias("version_doi"),
    )
    lost = judged.filter(
        F.col("concept").isNotNull() & (F.col("concept") != F.col("doi")) & F.col("_ok").isNull()
    ).select(F.col("concept").alias("doi"), F.lit("did-not-resolve").alias("reason"), F.col(key).cast("string").alias("context"))
    return settled, drops.unionByName(lost)


def match_titles(citations: DataFrame, works: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(matched, unresolved)``: citations found under exactly their normalised title.

    ``citations`` is ``(url, title)``, ``works`` ``(title, doi, rank)``; a near match is
    left to a person.
    """
    known = works.groupBy(tx.normalise_title(F.col("title")).alias("norm")).agg(F.min_by("doi", "rank").alias("doi"))
    rows = lookup_join(
        citations.withColumn("norm", tx.normalise_title(F.col("title"))), known, ["norm"], "left"
    ).drop("norm")
    missed = rows.filter(F.col("doi").isNull()).select(
        F.lit("unresolved_citation").alias("type"), "url", "title",
        F.lit("no exact title match; flagged rather than guessed").alias("detail"),
    )
    return rows.filter(F.col("doi").isNotNull()), missed


def under_held_identity(rows: DataFrame, queue: DataFrame) -> DataFrame:
    """Payload rows fetched for a backfill queue, kept under the identity that asked."""
    asked = queue.select("source_id", F.col("identity_key").alias("_held"))
    return rows.join(asked, "source_id", "left").withColumn(
        "identity_override", F.coalesce("identity_override", "_held")
    ).drop("_held")


def usable_hits(rows: DataFrame, tombstone: Column) -> DataFrame:
    """Listing hits worth mapping: a removed record is an event, never a scrape."""
    return rows.filter(get_doc(F.col("payload"), "$.id").isNotNull() & ~tombstone & (json_type(F.col("payload")) == "OBJECT"))
