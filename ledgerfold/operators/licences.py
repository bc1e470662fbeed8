"""Licence texts to register ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions import text as tx
from ledgerfold.session import small_side

UNMAPPED = "notspecified"


def normalise_licence(text: Column) -> Column:
    value = F.lower(tx.strip(text))
    value = F.replace(F.replace(value, F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
    value = F.regexp_replace(value, r"^(spdx:|info:eu-repo/semantics/)", "")
    value = F.regexp_replace(value, r"\bversion\b", "")
    return F.regexp_replace(F.regexp_replace(value, r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def map_licences(
    rows: DataFrame, column: str, aliases: DataFrame, id_name: str = "license_id",
    mapped_name: str = "license_mapped",
) -> DataFrame:
    """Add the register id of a licence text, and whether it was recognised.

    A text is looked up as it is, then without trailing version numbers. No text at
    all is "not specified" and counts as recognised: nothing went wrong.
    """
    key = normalise_licence(F.coalesce(F.col(column), F.lit("")))
    lookup = small_side(aliases)
    side = lambda n: lookup.select(F.col("alias").alias(n), F.col("license_id").alias(f"{n}_id"))
    found = (
        rows.withColumn("_exact", key)
        .withColumn("_bare", F.regexp_replace("_exact", r"-\d+(-\d+)*$", ""))
        .join(side("_exact"), "_exact", "left")
        .join(side("_bare"), "_bare", "left")
    )
    hit = F.coalesce("_exact_id", "_bare_id")
    return found.withColumns(
        {
            id_name: F.when(F.col("_exact") == "", F.lit(UNMAPPED)).otherwise(
                F.coalesce(hit, F.lit(UNMAPPED))
            ),
            mapped_name: (F.col("_exact") == "") | hit.isNotNull(),
        }
    ).drop("_exact", "_bare", "_exact_id", "_bare_id")


def unmapped_report(rows: DataFrame, raw: str = "license_raw", mapped: str = "license_mapped") -> DataFrame:
    return rows.filter(F.col(raw).isNotNull() & ~F.col(mapped))
