"""The small registers as DataFrames, and readers for a deployment's own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.functions import text as tx

# The licence register, (id, title, url, is_open, osi_approved).
LICENCES = (
    ("notspecified", "License not specified", "", False, False),
    ("odc-pddl", "Open Data Commons Public Domain Dedication and License (PDDL)",
     "http://www.opendefinition.org/licenses/odc-pddl", True, False),
    ("odc-odbl", "Open Data Commons Open Database License (ODbL)",
     "http://www.opendefinition.org/licenses/odc-odbl", True, False),
    ("odc-by", "Open Data Commons Attribution License",
     "http://www.opendefinition.org/licenses/odc-by", True, False),
    ("cc-zero", "Creative Commons CCZero", "http://www.opendefinition.org/licenses/cc-zero", True, False),
    ("cc-by", "Creative Commons Attribution", "http://www.opendefinition.org/licenses/cc-by", True, False),
    ("cc-by-sa", "Creative Commons Attribution Share-Alike",
     "http://www.opendefinition.org/licenses/cc-by-sa", True, False),
    ("gfdl", "GNU Free Documentation License", "http://www.opendefinition.org/licenses/gfdl", True, False),
    ("other-open", "Other (Open)", "", True, False),
    ("other-pd", "Other (Public Domain)", "", True, False),
    ("other-at", "Other (Attribution)", "", True, False),
    ("uk-ogl", "UK Open Government Licence (OGL)",
     "http://reference.data.gov.uk/id/open-government-licence", True, False),
    ("cc-nc", "Creative Commons Non-Commercial (Any)",
     "http://creativecommons.org/licenses/by-nc/2.0/", False, False),
    ("other-nc", "Other (Non-Commercial)", "", False, False),
    ("other-closed", "Other (Not Open)", "", False, False),
    ("mit", "MIT License", "https://opensource.org/licenses/MIT", True, True),
    ("apache", "Apache License 2.0", "https://opensource.org/licenses/Apache-2.0", True, True),
    ("bsd-2-clause", "BSD 2-Clause License", "https://opensource.org/licenses/BSD-2-Clause", True, True),
    ("bsd-3-clause", "BSD 3-Clause License", "https://opensource.org/licenses/BSD-3-Clause", True, True),
    ("gpl-2.0", "GNU General Public License v2.0", "https://opensource.org/licenses/GPL-2.0", True, True),
    ("gpl-3.0", "GNU General Public License v3.0", "https://opensource.org/licenses/GPL-3.0", True, True),
    ("lgpl-3.0", "GNU Lesser General Public License v3.0",
     "https://opensource.org/licenses/LGPL-3.0", True, True),
    ("agpl-3.0", "GNU Affero General Public License v3.0",
     "https://opensource.org/licenses/AGPL-3.0", True, True),
    ("mpl-2.0", "Mozilla Public License 2.0", "https://opensource.org/licenses/MPL-2.0", True, True),
    ("epl-2.0", "Eclipse Public License 2.0", "https://opensource.org/licenses/EPL-2.0", True, True),
    ("unlicense", "The Unlicense", "https://unlicense.org/", True, False),
    ("cc-by-nd", "Creative Commons Attribution No-Derivatives",
     "https://creativecommons.org/licenses/by-nd/4.0/", False, False),
    ("cc-nc-sa", "Creative Commons Attribution Non-Commercial Share-Alike",
     "https://creativecommons.org/licenses/by-nc-sa/4.0/", False, False),
    ("cc-nc-nd", "Creative Commons Attribution Non-Commercial No-Derivatives",
     "https://creativecommons.org/licenses/by-nc-nd/4.0/", False, False),
)
LICENCE_IDS = tuple(row[0] for row in LICENCES)

# Other spellings of a licence; ids, titles and URLs are spellings too.
LICENCE_SPELLINGS = {
    "cc-zero": (
        "cc0", "cc0-1.0", "CC0 1.0", "cc-0", "zero", "publicdomain/zero/1.0",
        "creativecommons.org/publicdomain/zero/1.0/", "Creative Commons Zero v1.0 Universal",
        "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication", "public domain dedication"),
    "cc-by": (
        "cc-by-1.0", "cc-by-2.0", "cc-by-2.5", "cc-by-3.0", "cc-by-4.0", "CC BY 4.0", "CC-BY",
        "creativecommons.org/licenses/by/4.0/", "creativecommons.org/licenses/by/3.0/",
        "Creative Commons Attribution 4.0 International",
        "Creative Commons Attribution 4.0 International License",
        "Creative Commons Attribution License"),
    "cc-by-sa": (
        "cc-by-sa-3.0", "cc-by-sa-4.0", "CC BY-SA 4.0", "creativecommons.org/licenses/by-sa/4.0/",
        "Creative Commons Attribution Share Alike 4.0 International",
        "Creative Commons Attribution-ShareAlike 4.0 International"),
    "cc-nc": (
        "cc-by-nc-3.0", "cc-by-nc-4.0", "CC BY-NC 4.0", "creativecommons.org/licenses/by-nc/4.0/",
        "Creative Commons Attribution Non Commercial 4.0 International"),
    "cc-nc-sa": (
        "cc-by-nc-sa-3.0", "cc-by-nc-sa-4.0", "CC BY-NC-SA 4.0",
        "Creative Commons Attribution Non Commercial Share Alike 4.0 International"),
    "cc-nc-nd": (
        "cc-by-nc-nd-3.0", "cc-by-nc-nd-4.0", "CC BY-NC-ND 4.0",
        "Creative Commons Attribution Non Commercial No Derivatives 4.0 International"),
    "cc-by-nd": (
        "cc-by-nd-3.0", "cc-by-nd-4.0", "CC BY-ND 4.0",
        "Creative Commons Attribution No Derivatives 4.0 International"),
    "mit": ("mit", "mit-license", "MIT License", "The MIT License", "expat"),
    "apache": (
        "apache-2.0", "apache-2", "asl-2.0", "Apache License 2.0", "Apache Software License 2.0",
        "Apache License, Version 2.0"),
    "bsd-2-clause": ("bsd-2-clause", "bsd-2", "simplified bsd", "freebsd"),
    "bsd-3-clause": (
        "bsd-3-clause", "bsd-3", "new bsd", "modified bsd",
        'BSD 3-Clause "New" or "Revised" License'),
    "gpl-2.0": (
        "gpl-2.0", "gpl-2.0-only", "gpl-2.0-or-later", "gplv2",
        "GNU General Public License v2.0 only"),
    "gpl-3.0": (
        "gpl-3.0", "gpl-3.0-only", "gpl-3.0-or-later", "gplv3", "gpl3",
        "GNU General Public License v3.0 or later", "GNU General Public License v3.0 only"),
    "lgpl-3.0": ("lgpl-3.0", "lgpl-3.0-only", "lgpl-3.0-or-later", "lgplv3"),
    "agpl-3.0": ("agpl-3.0", "agpl-3.0-only", "agpl-3.0-or-later", "agplv3"),
    "mpl-2.0": ("mpl-2.0", "mozilla public license 2.0"),
    "epl-2.0": ("epl-2.0", "eclipse public license 2.0"),
    "unlicense": ("unlicense", "the unlicense"),
    "odc-pddl": ("pddl-1.0", "odc-pddl-1.0", "opendatacommons.org/licenses/pddl/1.0/"),
    "odc-odbl": ("odbl-1.0", "odc-odbl-1.0", "opendatacommons.org/licenses/odbl/1.0/"),
    "odc-by": ("odc-by-1.0", "opendatacommons.org/licenses/by/1.0/"),
    "uk-ogl": ("ogl-uk-3.0", "open government licence"),
    "other-closed": (
        "closed", "proprietary", "all rights reserved", "copyright", "restricted", "other-closed",
        "info:eu-repo/semantics/closedAccess"),
    "other-open": ("open", "other-open", "open licence", "open license"),
    "other-pd": (
        "public domain", "publicdomain", "us government work", "public domain (usgov)"),
    "notspecified": (
        "", "none", "null", "n/a", "na", "unknown", "not specified", "no license", "no licence",
        "unspecified", "other"),
}

# Licence pages that exports may state as an IRI.
LICENCE_IRIS = {
    "cc-by": "https://creativecommons.org/licenses/by/4.0/",
    "cc-by-sa": "https://creativecommons.org/licenses/by-sa/4.0/",
    "cc-zero": "https://creativecommons.org/publicdomain/zero/1.0/",
    "cc-nc": "https://creativecommons.org/licenses/by-nc/4.0/",
    "cc-nc-sa": "https://creativecommons.org/licenses/by-nc-sa/4.0/",
    "cc-nc-nd": "https://creativecommons.org/licenses/by-nc-nd/4.0/",
    "cc-by-nd": "https://creativecommons.org/licenses/by-nd/4.0/",
    "mit": "https://opensource.org/licenses/MIT",
    "apache": "https://opensource.org/licenses/Apache-2.0",
    "bsd-3-clause": "https://opensource.org/licenses/BSD-3-Clause",
    "bsd-2-clause": "https://opensource.org/licenses/BSD-2-Clause",
    "gpl-3.0": "https://opensource.org/licenses/GPL-3.0",
    "gpl-2.0": "https://opensource.org/licenses/GPL-2.0",
    "lgpl-3.0": "https://opensource.org/licenses/LGPL-3.0",
    "agpl-3.0": "https://opensource.org/licenses/AGPL-3.0",
    "mpl-2.0": "https://opensource.org/licenses/MPL-2.0",
    "epl-2.0": "https://opensource.org/licenses/EPL-2.0",
    "unlicense": "https://unlicense.org/",
}

# Resource types and the kind each sits under.
TYPE_KIND = {
    "journal-article": "publication", "conference-paper": "publication", "preprint": "publication",
    "thesis": "publication", "book-chapter": "publication", "working-paper": "publication",
    "publication": "publication",
    "recommended-practice": "report", "best-practice": "report", "expert-group-report": "report",
    "tem-proceedings": "report", "technical-report": "report", "annual-report": "report",
    "project-deliverable": "report", "report": "report",
    "dataset": "dataset", "research-software": "software", "other-software": "software",
    "model": "model", "presentation": "other", "poster": "other", "meeting-record": "other",
    "image": "other", "video": "other", "other": "other",
}


def licence_register(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(LICENCES), "id string, title string, url string, is_open boolean, osi_approved boolean"
    )


def licence_aliases(spark: SparkSession) -> DataFrame:
    """``(alias, license_id)`` with aliases in normalised spelling; later lists win."""
    from ledgerfold.operators.licences import normalise_licence

    rows = [(i, text) for i, title, url, _, _ in LICENCES for text in (i, title, url) if text]
    rows += [(i, text) for i, texts in LICENCE_SPELLINGS.items() for text in texts]
    frame = spark.createDataFrame(
        [(n, i, t) for n, (i, t) in enumerate(rows)], "pos int, license_id string, text string"
    )
    return (
        frame.groupBy(normalise_licence(F.col("text")).alias("alias"))
        .agg(F.max_by("license_id", "pos").alias("license_id"))
    )


def licence_export(spark: SparkSession) -> DataFrame:
    """The register in the shape a catalogue server imports, ordered by id."""
    return (
        licence_register(spark)
        .select(
            "id", "title", "url", F.col("is_open").alias("is_okd_compliant"),
            F.col("osi_approved").alias("is_osi_compliant"),
        )
        .orderBy("id")
    )


SOURCES_DDL = "name string, enabled boolean, tier int, precedence int, generic_routes array<string>"
ORGANISATIONS_DDL = "pos int, name string, title string, aliases array<string>"
GROUPS_DDL = "pos int, name string, title string, url string, aliases array<string>"
VOCABULARY_DDL = (
    "section string, name string, kind string, label string, plural string, definition string, authority string"
)


def read_register(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A register kept as JSON lines with a stated schema."""
    return spark.read.schema(ddl).json(path)


def labelled(rows: DataFrame, column: str, register: DataFrame, out: str, label: str = "title") -> DataFrame:
    """Add a label from a register keyed by ``name``, else the raw value."""
    names = register.select(F.col("name").alias(column), F.col(label).alias("_label"))
    return rows.join(names, column, "left").withColumn(out, F.coalesce("_label", column)).drop("_label")


def short_title(title):
    """``Task 43`` out of ``Task 43 — Digitalisation``."""
    found = F.regexp_extract(title, r"^(Task [\d/]+)", 1)
    return F.when(found != "", found).otherwise(title)


def normalised_names(organisations: DataFrame) -> DataFrame:
    """``(alias, org, pos)``: every spelling of every organisation, normalised."""
    spellings = F.concat(
        F.array("name", "title"), F.coalesce("aliases", F.array().cast("array<string>"))
    )
    return (
        organisations.select(F.col("name").alias("org"), "pos", F.explode(spellings).alias("text"))
        .select(tx.normalise_words(F.col("text")).alias("alias"), "org", "pos")
        .filter(F.col("alias") != "")
        .groupBy("alias")
        .agg(F.min_by("org", "pos").alias("org"))
    )
