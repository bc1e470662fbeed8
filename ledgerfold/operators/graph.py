"""The citation graph over identities, and the scope decision it feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerfold.functions import text as tx
from ledgerfold.functions.jsonval import get_strings, text_of
from ledgerfold.operators.skew import lookup_join

# Relations that state a citation, from either side.
CITES = ("references", "cites", "iscitationof")
CITED_BY = ("iscitedby", "citedby", "isreferencedby")


def claimed_identifiers(resolved: DataFrame) -> DataFrame:
    """``(identity_key, doi)`` for the DOI an identity is and the one it states."""
    own = F.when(tx.identity_kind(F.col("identity_key")) == "doi", F.col("identity_key"))
    stated = tx.normalise_doi(text_of(F.element_at("effective", "doi")))
    return resolved.select(
        "identity_key",
        F.explode(F.array_distinct(F.array_compact(F.array(own, stated)))).alias("doi"),
    )


def stated_names(resolved: DataFrame) -> DataFrame:
    """``(identity_key, alias, own)``: what citations may call a record, its key and the DOI that it states."""
    key = F.col("identity_key")
    stated = tx.normalise_doi(text_of(F.element_at("effective", "doi")))
    names = resolved.select(key, F.lower(tx.strip(key)).alias("alias"), F.lit(True).alias("own"))
    claims = resolved.select(key, stated.alias("alias"), F.lit(False).alias("own")).filter(F.col("alias").isNotNull())
    return names.unionByName(claims)


def alias_owner(names: DataFrame) -> DataFrame:
    """``(alias, identity_key)``: a key always beats a stated DOI, the greatest key wins among spellings of one
    key, the smallest among claims."""
    key = F.col("identity_key")
    owner = F.coalesce(F.max(F.when(F.col("own"), key)), F.min(key))
    return names.groupBy("alias").agg(owner.alias("identity_key"))


def alias_index_scope(resolved: DataFrame) -> DataFrame:
    """``(alias, identity_key)`` for citations."""
    return alias_owner(stated_names(resolved))


def alias_index_merge(resolved: DataFrame) -> DataFrame:
    """``(alias, identity_key)`` for merging: first come in key order, keys, their
    lower-case form and claimed DOIs alike."""
    key = F.col("identity_key")
    names = resolved.select(F.explode(F.array_distinct(F.array(key, F.lower(key)))).alias("alias"), key)
    claims = claimed_identifiers(resolved).select(F.col("doi").alias("alias"), key)
    return names.unionByName(claims).groupBy("alias").agg(F.min("identity_key").alias("identity_key"))


def related_identifiers(resolved: DataFrame) -> DataFrame:
    """``(identity_key, pos, relation, identifier)``, one row per stated relation."""
    items = F.try_variant_get(
        F.try_parse_json(F.element_at("effective", "related_identifiers")), "$", "array<variant>"
    )
    rows = resolved.select("identity_key", F.posexplode(items).alias("pos", "item"))
    return rows.select(
        "identity_key",
        "pos",
        F.try_variant_get("item", "$.relation", "string").alias("relation"),
        F.try_variant_get("item", "$.identifier", "string").alias("identifier"),
    )


def stated_citations(resolved: DataFrame, references_key: str = "crossref_references") -> DataFrame:
    """``(identity_key, alias, outward)``: what a record says it cites, or is cited by."""
    extra = F.try_parse_json(F.element_at("effective", "extra"))
    listed = resolved.select(
        "identity_key",
        F.explode(get_strings(extra, f"$.{references_key}")).alias("raw"),
    ).select("identity_key", tx.normalise_doi(F.col("raw")).alias("alias"), F.lit(True).alias("outward"))
    relation = F.lower(tx.strip(F.coalesce("relation", F.lit(""))))
    target = F.lower(tx.strip(F.coalesce("identifier", F.lit(""))))
    related = (
        related_identifiers(resolved)
        .filter(relation.isin(*CITES, *CITED_BY) & (target != ""))
        .select(
            "identity_key",
            F.coalesce(tx.normalise_doi(target), target).alias("alias"),
            relation.isin(*CITES).alias("outward"),
        )
    )
    return listed.unionByName(related).filter(F.col("alias").isNotNull())


def citation_edges(statements: DataFrame, index: DataFrame) -> DataFrame:
    """Distinct ``(src, dst)``: src cites dst, both in the catalogue, never itself.

    Statements are made distinct before they meet the index, so a record cited by
    everyone costs one row per citing record and no more.
    """
    asked = statements.select("identity_key", "alias", "outward").distinct()
    hits = lookup_join(asked, index.withColumnRenamed("identity_key", "other"), ["alias"]).filter(
        F.col("other") != F.col("identity_key")
    )
    src = F.when(F.col("outward"), F.col("identity_key")).otherwise(F.col("other"))
    dst = F.when(F.col("outward"), F.col("other")).otherwise(F.col("identity_key"))
    return hits.select(src.alias("src"), dst.alias("dst")).distinct()


def first_values(rows: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """The ``n`` smallest values per key as ``(key, best ARRAY)``; rows are distinct.

    The rank filter is applied on each map task before the shuffle, so a key with
    very many values sends at most ``n`` of them per task.
    """
    rank = F.row_number().over(W.partitionBy(key).orderBy(value))
    kept = rows.select(key, value, rank.alias("_rank")).filter(F.col("_rank") <= n)
    return kept.groupBy(key).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_rank", F.col(value).alias("v")))), lambda r: r["v"]
        ).alias("best")
    )


def scope_basis(
    routes: Column, tasks: Column, generic: Column, cites: Column, cited_by: Column
) -> Column:
    """``STRUCT<basis, evidence>`` from arrays; ``routes`` is empty when none was recorded.

    ``cites``/``cited_by`` hold the first three neighbours in name order.
    """
    text = F.array().cast("array<string>")
    attributing = F.array_except(F.coalesce(routes, text), generic)
    named = F.array_sort(F.filter(F.coalesce(tasks, text), lambda t: t != ""))
    out, back = F.coalesce(cites, text), F.coalesce(cited_by, text)

    def verdict(basis: str, *evidence: Column) -> Column:
        return F.struct(F.lit(basis).alias("basis"), F.concat(*evidence).alias("evidence"))

    # The sentences a reader checks a decision by.
    return (
        F.when(
            F.size(attributing) > 0,
            verdict("direct", F.lit("Found through "), tx.english_list(attributing),
                    F.lit(", which is a programme attribution.")),
        )
        .when(F.size(named) > 0,
              verdict("direct", F.lit("Attributed to "), tx.english_list(named), F.lit(".")))
        .when(F.size(out) > 0,
              verdict("cites", F.lit("Cites "), tx.english_list(out),
                      F.lit(", which the catalogue holds.")))
        .when(F.size(back) > 0,
              verdict("cited-by", F.lit("Cited by "), tx.english_list(back),
                      F.lit(", which the catalogue holds.")))
        .when(F.size(F.coalesce(routes, text)) == 0,
              verdict("unassessed", F.lit(
                  "Harvested before the catalogue recorded discovery routes, and not re-scraped "
                  "since; its grounds have not been established.")))
        .otherwise(
            verdict("none", F.lit(
                "No programme attribution, and no citation link to anything in the catalogue.")))
    )


def decide_scope(
    resolved: DataFrame, edges: DataFrame | None, generic_routes: list[str], task_field: str = "task"
) -> DataFrame:
    """``(identity_key, inclusion_basis, inclusion_evidence)`` for every identity.

    Without ``edges`` (a single-record replay) only the direct limb can be known.
    """
    rows = resolved.select(
        "identity_key",
        "discovered_via",
        get_strings(F.try_parse_json(F.element_at("effective", task_field)), "$").alias("tasks"),
    )
    none = F.array().cast("array<string>")
    if edges is None:
        rows = rows.withColumns({"cites": none, "cited_by": none})
    else:
        out = first_values(edges, "src", "dst", 3).withColumnsRenamed({"src": "identity_key", "best": "cites"})
        back = first_values(edges, "dst", "src", 3).withColumnsRenamed({"dst": "identity_key", "best": "cited_by"})
        rows = rows.join(out, "identity_key", "left").join(back, "identity_key", "left")
    generic = F.array(*[F.lit(r) for r in generic_routes]) if generic_routes else none
    verdict = scope_basis(F.col("discovered_via"), F.col("tasks"), generic, F.col("cites"), F.col("cited_by"))
    return rows.select(
        "identity_key",
        verdict["basis"].alias("inclusion_basis"),
        verdict["evidence"].alias("inclusion_evidence"),
    )


def scope_tally(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("inclusion_basis").agg(F.count(F.lit(1)).alias("records"))


def neighbours(touched: DataFrame, edges: DataFrame) -> DataFrame:
    """Touched identities and everything one citation away: the rows whose scope may
    change when the touched ones do."""
    ids = touched.select("identity_key").distinct()
    out = edges.join(ids, edges.src == ids.identity_key, "left_semi").select(F.col("dst").alias("identity_key"))
    back = edges.join(ids, edges.dst == ids.identity_key, "left_semi").select(F.col("src").alias("identity_key"))
    return ids.unionByName(out).unionByName(back).distinct()
