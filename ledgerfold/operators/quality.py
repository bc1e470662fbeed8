"""Data-quality gates: violations as rows, never as exceptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.urls import ALLOWED_SCHEMES, safe_url
from ledgerfold.operators.skew import per_key_join
from ledgerfold.sources.registers import LICENCE_IDS, TYPE_KIND
from ledgerfold.spec import (
    ACCESS_STATUSES,
    MAX_COLLECTION_ITEMS,
    MAX_TEXT_LENGTH,
    PACKAGE_STATES,
    RESOURCE_KINDS,
)

NAME_RULE = r"^[a-z0-9_-]{2,100}$"
TAG_RULE = r"^[A-Za-z0-9._-]{2,100}$"


def problem(condition: Column, field: Column | str, message: Column | str) -> Column:
    as_col = lambda v: F.lit(v) if isinstance(v, str) else v
    return F.when(
        F.coalesce(condition, F.lit(False)),
        F.struct(as_col(field).alias("field"), as_col(message).alias("message")),
    )


def name_problem(name: Column) -> Column:
    missing = F.coalesce(name, F.lit("")) == ""
    return F.coalesce(
        problem(missing, "name", "missing"),
        problem(~name.rlike(NAME_RULE), "name", F.concat(name, F.lit(
            " is not a legal name (lowercase a-z, 0-9, '-' and '_' only, 2-100 chars)"))),
    )


def title_problem(title: Column) -> Column:
    return problem(F.trim(F.coalesce(title, F.lit(""))) == "", "title", "missing or empty")


def notes_problem(notes: Column) -> Column:
    return problem(
        F.length(notes) > MAX_TEXT_LENGTH, "notes",
        F.concat(F.length(notes), F.lit(f" characters, over the {MAX_TEXT_LENGTH}-character cap")),
    )


def licence_problem(licence: Column) -> Column:
    return F.coalesce(
        problem(F.coalesce(licence, F.lit("")) == "", "license_id",
                "missing (use 'notspecified', never an empty string)"),
        problem(~licence.isin(*LICENCE_IDS), "license_id",
                F.concat(licence, F.lit(" is not in the licence register"))),
    )


def row_problems(checks: list[Column]) -> Column:
    """The failed checks of a row, in order."""
    return F.array_compact(F.array(*checks))


def _duplicates(values: Column, label: str, message: str) -> Column:
    """Problems for members equal to an earlier legal member."""
    return F.transform(
        values,
        lambda v, i: F.when(
            F.array_position(values, v) < i + 1,
            F.struct(
                F.concat(F.lit(f"{label}["), i.cast("string"), F.lit("]")).alias("field"),
                F.concat(F.lit(f"{message} "), v).alias("message"),
            ),
        ),
    )


def _at(label: str, i: Column) -> Column:
    return F.concat(F.lit(f"{label}["), i.cast("string"), F.lit("]"))


def _url_message(url: Column) -> Column:
    return F.concat(url, F.lit(f" is not an allowed URL scheme (allowed: {', '.join(ALLOWED_SCHEMES)})"))


def too_many(items: Column, label: str) -> Column:
    """One problem for a list that is longer than readers expect; its members are checked all the same."""
    said = F.concat(F.size(items), F.lit(f" {label}, more than {MAX_COLLECTION_ITEMS}"))
    return F.array(problem(F.size(items) > MAX_COLLECTION_ITEMS, label, said))


def tag_problems(names: Column) -> Column:
    illegal = F.transform(
        names,
        lambda t, i: problem(~F.coalesce(t.rlike(TAG_RULE), F.lit(False)), _at("tags", i),
                             F.concat(F.coalesce(t, F.lit("null")), F.lit(
                                 " is not a legal tag (A-Z a-z 0-9 '-' '_' '.', 2-100 chars)"))),
    )
    legal = F.transform(names, lambda t: F.when(t.rlike(TAG_RULE), t))
    repeated = F.transform(
        legal,
        lambda t, i: F.when(
            t.isNotNull() & (F.array_position(legal, t) < i + 1),
            F.struct(_at("tags", i).alias("field"), F.concat(F.lit("duplicate tag "), t).alias("message")),
        ),
    )
    return F.array_compact(F.concat(too_many(names, "tags"), illegal, repeated))


def extra_problems(keys: Column, values: Column) -> Column:
    blank = F.transform(
        keys, lambda k, i: problem(F.trim(F.coalesce(k, F.lit(""))) == "", _at("extras", i),
                                   "key must be a non-empty string"))
    missing = F.transform(
        F.arrays_zip(keys.alias("k"), values.alias("v")),
        lambda e: problem(e["v"].isNull(), F.concat(F.lit("extras["), e["k"], F.lit("]")),
                          "value must be a string"))
    return F.array_compact(F.concat(blank, _duplicates(keys, "extras", "duplicate extras key"), missing))


def resource_problems(urls: Column) -> Column:
    checks = F.transform(
        urls,
        lambda u, i: F.coalesce(
            problem(F.coalesce(u, F.lit("")) == "", _at("resources", i), "resource has no url"),
            problem(safe_url(u).isNull(), _at("resources", i), _url_message(u)),
        ),
    )
    return F.array_compact(F.concat(too_many(urls, "resources"), checks))


def package_violations(packages: DataFrame, organisations: DataFrame, groups: DataFrame) -> DataFrame:
    """``(record, field, message)``: every reason a catalogue server would refuse a record."""
    record = F.coalesce(F.when(F.col("name") != "", F.col("name")), F.lit("<unnamed>"))
    none = F.array().cast("array<struct<field:string,message:string>>")
    names = lambda c: F.transform(c, lambda t: t["name"])
    own = row_problems(
        [
            name_problem(F.col("name")),
            title_problem(F.col("title")),
            notes_problem(F.col("notes")),
            licence_problem(F.col("license_id")),
            problem(F.col("url").isNotNull() & safe_url(F.col("url")).isNull(), "url", _url_message(F.col("url"))),
            problem(F.col("owner_org").isNull(), "owner_org", "missing — a record needs an owning organisation"),
            problem(F.col("owner_org") == "", "owner_org", "must be a non-empty string"),
            problem(~F.col("state").isin(*PACKAGE_STATES), "state",
                    F.concat("state", F.lit(f" is not one of {', '.join(PACKAGE_STATES)}"))),
        ]
    )
    lists = F.concat(
        F.coalesce(tag_problems(names(F.col("tags"))), none),
        F.coalesce(extra_problems(F.transform("extras", lambda e: e["key"]),
                                  F.transform("extras", lambda e: e["value"])), none),
        F.coalesce(resource_problems(F.transform("resources", lambda r: r["url"])), none),
    )
    inside = packages.select(record.alias("record"), F.explode(F.concat(own, lists)).alias("p")).select(
        "record", "p.*"
    )
    owners = (
        packages.filter(F.coalesce("owner_org", F.lit("")) != "")
        .select(record.alias("record"), "owner_org")
        .join(organisations.select(F.col("name").alias("owner_org")), "owner_org", "left_anti")
        .select("record", F.lit("owner_org").alias("field"),
                F.concat("owner_org", F.lit(" is not registered")).alias("message"))
    )
    grouped = packages.select(record.alias("record"), F.posexplode("groups").alias("pos", "g")).select(
        "record", "pos", F.col("g.name").alias("group")
    )
    unnamed = grouped.filter(F.coalesce("group", F.lit("")) == "").select(
        "record", _at("groups", F.col("pos")).alias("field"), F.lit("must be an object with a 'name'").alias("message")
    )
    unknown = (
        grouped.filter(F.col("group") != "")
        .join(groups.select(F.col("name").alias("group")), "group", "left_anti")
        .select("record", _at("groups", F.col("pos")).alias("field"),
                F.concat("group", F.lit(" is not registered")).alias("message"))
    )
    return inside.unionByName(owners).unionByName(unnamed).unionByName(unknown)


def duplicate_names(rows: DataFrame, name: str, path: str) -> DataFrame:
    """Rows whose name an earlier path holds already, with that path."""
    first = rows.groupBy(name).agg(F.min(path).alias("first_path"), F.count(F.lit(1)).alias("rows")).filter(
        F.col("rows") > 1
    )
    return (
        per_key_join(rows.select(name, path), first, [name])
        .filter(F.col(path) != F.col("first_path"))
        .select(F.col(name).alias("record"), F.lit("name").alias("field"),
                F.concat(F.lit("duplicate name, also in "), F.col("first_path").cast("string")).alias("message"),
                path)
    )


def misnamed_files(rows: DataFrame, name: str, stem: str) -> DataFrame:
    return rows.filter((F.col(name) != "") & (F.col(name) != F.col(stem))).select(
        F.col(name).alias("record"), F.lit("name").alias("field"),
        F.concat(F.lit("does not match filename stem "), F.col(stem)).alias("message"),
    )


def missing_from(rows: DataFrame, register: DataFrame, column: str, key: str, what: str) -> DataFrame:
    """Distinct values of a column that a register lacks."""
    return (
        rows.select(F.col(column).alias("value")).filter(F.col("value").isNotNull()).distinct()
        .join(register.select(F.col(key).alias("value")), "value", "left_anti")
        .select(F.lit(what).alias("what"), F.col("value").cast("string").alias("value"))
    )


def vocabulary_problems(vocabulary: DataFrame, authorities: DataFrame) -> DataFrame:
    """Where the vocabulary register and the derivation disagree, as messages.

    ``vocabulary`` is ``(section, name, kind, definition, authority)`` with sections
    ``resource_kind``, ``resource_type``, ``access_status`` and ``term``.
    """
    spark = vocabulary.sparkSession
    section = lambda s: vocabulary.filter(F.col("section") == s)
    listed = lambda s, values: spark.createDataFrame([(s, v) for v in values], "section string, name string")
    expected = (
        listed("resource_kind", RESOURCE_KINDS)
        .unionByName(listed("access_status", ACCESS_STATUSES))
        .unionByName(listed("resource_type", sorted(TYPE_KIND)))
    )
    undefined = expected.join(vocabulary, ["section", "name"], "left_anti").select(
        F.concat_ws(" ", "section", "name", F.lit("can be produced but is not defined")).alias("message")
    )
    unused = section("resource_kind").join(expected, ["section", "name"], "left_anti").select(
        F.concat_ws(" ", F.lit("resource_kind"), "name", F.lit("is defined but unknown here")).alias("message")
    )
    orphan = (
        section("resource_type")
        .join(section("resource_kind").select(F.col("name").alias("kind")), "kind", "left_anti")
        .select(F.concat_ws(" ", F.lit("resource_type"), "name", F.lit("names unknown kind"), "kind").alias("message"))
    )
    blank = vocabulary.filter(F.trim(F.coalesce("definition", F.lit(""))) == "").select(
        F.concat_ws(" ", "section", "name", F.lit("has no definition")).alias("message")
    )
    authority = (
        vocabulary.filter(F.col("authority").isNotNull())
        .join(authorities.select(F.col("name").alias("authority")), "authority", "left_anti")
        .select(F.concat_ws(" ", "section", "name", F.lit("names unknown authority"), "authority").alias("message"))
    )
    return undefined.unionByName(unused).unionByName(orphan).unionByName(blank).unionByName(authority)


def export_violations(exports: DataFrame) -> DataFrame:
    """Promises of the exports, broken: ``exports`` is ``(loc, kind, schema_type,
    license_id, licence_iri, withdrawn, distributions)``."""
    from ledgerfold.sources.registers import LICENCE_IRIS

    repeated = exports.groupBy("loc").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select(
        "loc", F.lit("listed more than once").alias("message")
    )
    rows = exports.select(
        "loc",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("kind").isin("dataset", "model") & (F.col("schema_type") != "Dataset"),
                           "holds data but is not typed Dataset"),
                    F.when(F.col("licence_iri").isNotNull() & ~F.col("license_id").isin(*LICENCE_IRIS),
                           "states a licence IRI nobody gave"),
                    F.when(F.col("withdrawn") & (F.col("distributions") > 0),
                           "withdrawn but still lists downloads"),
                )
            )
        ).alias("message"),
    )
    return repeated.unionByName(rows)
