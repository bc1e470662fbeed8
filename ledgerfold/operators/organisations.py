"""Matching free-text institutions to registered organisations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions import text as tx
from ledgerfold.functions.jsonval import get_doc, get_strings, get_text, json_type, text_of
from ledgerfold.operators.skew import gridded, lookup_join
from ledgerfold.sources.registers import normalised_names

DEFAULT_OWNER = "unattributed"
SOURCE_OWNER = {"zenodo": "zenodo-community"}
#: Texts with one word that meet aliases in one task.
MET_ROWS = 200_000


def match_texts(texts: DataFrame, names: DataFrame) -> DataFrame:
    """``(text, org)`` for distinct texts that name an organisation.

    An alias matches whole words of the text, the longest alias first. Every alias is filed under the one of its words that
    fewest aliases have; a text meets the aliases filed under its distinct words, and then the whole alias is looked for in it. So
    the register is never scanned per text, and a text makes no more rows than it has words. A word of very many texts is dealt to
    blocks. ``names`` is ``(alias, org)``.
    """
    filed = names.select("alias", "org", F.explode(F.array_distinct(F.split("alias", " "))).alias("word"))
    spread = filed.groupBy("word").agg(F.count(F.lit(1)).alias("aliases"))
    rarest = filed.join(spread, "word").groupBy("alias", "org").agg(F.min(F.struct("aliases", "word"))["word"].alias("word"))
    plain = texts.select("text").distinct().withColumn("plain", tx.normalise_words(F.col("text")))
    words = plain.select("text", "plain", F.explode(F.array_distinct(F.split("plain", " "))).alias("word"))
    bounded = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    met = gridded(words, rarest, ["word"], "text", "alias", MET_ROWS).filter(F.contains(bounded(F.col("plain")), bounded(F.col("alias"))))
    order = F.struct((-F.length("alias")).alias("l"), "alias")
    return met.groupBy("text").agg(F.min_by("org", order).alias("org"))


def owner_signals(resolved: DataFrame) -> DataFrame:
    """``(identity_key, pos, basis, text)``: the texts to try, strongest first."""
    extra = F.try_parse_json(F.element_at("effective", "extra"))
    authors = F.try_variant_get(
        F.try_parse_json(F.element_at("effective", "authors")), "$", "array<variant>"
    )
    objects = F.filter(
        F.coalesce(authors, F.array().cast("array<variant>")), lambda a: json_type(a) == "OBJECT"
    )
    signal = lambda basis, text: F.struct(F.lit(basis).alias("basis"), text.alias("text"))

    def listed(key: str):
        doc = get_doc(extra, f"$.{key}")
        values = F.when(json_type(doc) == "ARRAY", get_strings(extra, f"$.{key}")).otherwise(
            F.array(get_text(extra, f"$.{key}"))
        )
        return F.transform(values, lambda v: signal(f"extra.{key}", v))

    people = F.transform(
        objects,
        lambda a, i: F.struct(
            F.when(i == 0, "first-author-affiliation").otherwise("author-affiliation").alias("basis"),
            F.try_variant_get(a, "$.affiliation", "string").alias("text"),
        ),
    )
    chain = F.concat(
        listed("osti_research_orgs"), listed("research_orgs"), listed("research_org"),
        F.array(signal("github-owner", get_text(extra, "$.github_owner"))),
        people,
        F.array(signal("publisher", text_of(F.element_at("effective", "publisher")))),
        F.array(signal("container", text_of(F.element_at("effective", "container")))),
    )
    rows = resolved.select("identity_key", F.posexplode(chain).alias("pos", "s"))
    return rows.select("identity_key", "pos", "s.basis", "s.text").filter(
        F.coalesce("text", F.lit("")) != ""
    )


def first_match(signals: DataFrame, names: DataFrame) -> DataFrame:
    """``(identity_key, org, basis)`` of the strongest signal that names an organisation."""
    matched = lookup_join(signals, match_texts(signals, names), ["text"])
    return (
        matched.groupBy("identity_key")
        .agg(F.min_by(F.struct("org", "basis"), "pos").alias("m"))
        .select("identity_key", "m.org", "m.basis")
    )


def infer_owner(resolved: DataFrame, organisations: DataFrame) -> DataFrame:
    """``(identity_key, owner_org, basis)`` for every record: stated, matched, or the
    fallback of its source."""
    known = organisations.select(F.col("name").alias("stated"), F.lit(True).alias("known"))
    stated = resolved.select(
        "identity_key", "source_system",
        tx.blank_to_null(text_of(F.element_at("effective", "owner_org"))).alias("stated"),
    ).join(known, "stated", "left")
    fallbacks = F.create_map(*[F.lit(x) for kv in SOURCE_OWNER.items() for x in kv])
    wanted = F.coalesce(F.element_at(fallbacks, F.col("source_system")), F.lit(DEFAULT_OWNER))
    names = organisations.select(F.col("name").alias("fallback"), F.lit(True).alias("fallback_known"))
    found = first_match(owner_signals(resolved), normalised_names(organisations))
    return (
        stated.withColumn("fallback", wanted)
        .join(names, "fallback", "left")
        .join(found, "identity_key", "left")
        .select(
            "identity_key",
            F.when(F.col("known"), F.col("stated"))
            .when(F.col("org").isNotNull(), F.col("org"))
            .when(F.col("fallback_known"), F.col("fallback"))
            .otherwise(DEFAULT_OWNER)
            .alias("owner_org"),
            F.when(F.col("known"), "stated").otherwise(F.coalesce("basis", F.lit("fallback"))).alias("basis"),
        )
    )
