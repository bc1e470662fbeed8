"""The ledger contract: column names, enumerations and fold configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

# The closed vocabularies of the ledger and of packages.
EVENT_TYPES = (
    "scraped",
    "annotated",
    "withdrawn",
    "displacement_notice",
    "pin_notice",
    "merge_proposal",
)
NOTICE_EVENT_TYPES = ("displacement_notice", "pin_notice", "merge_proposal")
SEEN_EVENT_TYPES = ("scraped", "withdrawn")
EXTRACTION_METHODS = ("api", "pattern", "llm", "curator")
RESOURCE_KINDS = ("dataset", "publication", "software", "report", "model", "other")
ACCESS_STATUSES = (
    "open",
    "restricted",
    "embargoed",
    "registration-required",
    "metadata-only",
    "unknown",
)
PACKAGE_STATES = ("active", "deleted", "draft")
INCLUSION_BASES = ("direct", "cites", "cited-by", "unassessed", "none")
EVENT_KEYS = (
    "observed_at",
    "event_type",
    "identity_key",
    "source_key",
    "source_system",
    "source_id",
    "source",
    "local",
    "provenance",
    "discovered_via",
    "notice",
    "actor",
    "note",
)
#: Longer texts and lists are kept, and reported by the gate.
MAX_TEXT_LENGTH = 64 * 1024
MAX_COLLECTION_ITEMS = 500

#: Precedence when a register declares none; lower wins.
DEFAULT_PRECEDENCE = {
    "datacite": 10,
    "crossref": 20,
    "zenodo": 30,
    "osti": 40,
    "wdh": 50,
    "github": 60,
    "task_pages": 90,
}
UNKNOWN_PRECEDENCE = 500

PROVENANCE_TYPE = (
    "map<string,struct<extraction_method:string,model:string,prompt_version:string,"
    "confidence:double,source_system:string,pinned:boolean>>"
)

#: DDL of the ledger. ``source``/``local``/``notice`` hold canonical JSON text,
#: so the table can live in any format and be grouped, hashed and compared.
EVENT_DDL = (
    "seq bigint, observed_at string, event_type string, identity_key string, "
    "source_key string, source_id string, source_system string, source string, "
    f"local string, provenance {PROVENANCE_TYPE}, discovered_via array<string>, "
    "notice string, actor string, note string"
)


@dataclass(frozen=True)
class LedgerSpec:
    """How a ledger folds. One instance serves every operator of a run."""

    #: Fields whose values union instead of displacing each other.
    set_fields: tuple[str, ...] = (
        "task",
        "source_urls",
        "keywords",
        "related_identifiers",
        "curator_notes",
        "links",
        "merged_from",
    )
    #: Fields that are bags merged key by key.
    bag_fields: tuple[str, ...] = ("extra",)
    #: The field naming the programme task a record is attributed to.
    task_field: str = "task"
    #: The scrape field that asserts or lifts a withdrawal.
    withdrawal_field: str = "withdrawn"
    precedence: dict[str, int] = field(default_factory=lambda: dict(DEFAULT_PRECEDENCE))
    #: Characters of ``observed_at`` that cut a long history into time segments,
    #: so that one hot identity is never sorted by a single task (13 = one hour).
    segment_chars: int = 13
