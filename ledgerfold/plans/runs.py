"""Whole runs: payloads in, published records and a report out."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.operators import curation, graph, packages, quality, reconcile, reports
from ledgerfold.operators.changes import changed_rows, last_tokens
from ledgerfold.operators.ledger import append_events, event_frame, notice_events, read_table, scrape_events, with_seq
from ledgerfold.operators.resolve import resolve, system_state
from ledgerfold.session import checkpointed
from ledgerfold.sources.keyed import KeyedTable, named_once, publish
from ledgerfold.spec import LedgerSpec


@dataclass(frozen=True)
class Registers:
    """The small tables a run looks things up in."""

    organisations: DataFrame  # pos, name, title, aliases
    groups: DataFrame  # pos, name, title, url, aliases
    generic_routes: list[str] = field(default_factory=list)
    programme: str | None = None
    #: Phrases of titles, in lower case, and the types they name.
    title_phrases: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Catalogue:
    """What a materialisation gives."""

    resolved: DataFrame
    scope: DataFrame
    packages: DataFrame
    violations: DataFrame
    notices: DataFrame
    actions: DataFrame | None


def fold(events: DataFrame, spec: LedgerSpec) -> DataFrame:
    """Resolved records, stored. The state per identity and system is stored on the
    way, so the ledger is aggregated once and every later step reads the small table."""
    return checkpointed(resolve(events, spec, checkpointed(system_state(events, spec))))


def materialise(
    events: DataFrame,
    registers: Registers,
    spec: LedgerSpec | None = None,
    published: DataFrame | None = None,
    names: KeyedTable | None = None,
) -> Catalogue:
    """Events to packages, with the gate's verdict and what publishing would change.

    ``names`` is the register of published names; newcomers are entered in it, and who is in it keeps its name. The resolved records are written once to the checkpoint folder: scope, owners,
    tasks and packages all read them, and scope needs every record before any can be
    decided. ``published`` is ``(name, digest)`` of what is out there.
    """
    spec = spec or LedgerSpec()
    resolved = fold(events, spec)
    edges = graph.citation_edges(graph.stated_citations(resolved), graph.alias_index_scope(resolved))
    scope = graph.decide_scope(resolved, edges, registers.generic_routes, spec.task_field)
    firsts = events.groupBy("identity_key").agg(F.min("seq").alias("first_seq"))
    slugs = packages.allocate_slugs(firsts) if names is None else named_once(names, firsts)
    built, notices = packages.build_packages(
        resolved, scope, slugs, registers.organisations, registers.groups, spec, registers.programme, registers.title_phrases
    )
    built = checkpointed(built)
    collisions = packages.slug_collisions(built).select(
        F.col("name").alias("record"), F.lit("name").alias("field"),
        F.concat(F.lit("slug collision between "), F.col("identities").cast("string"), F.lit(" identities")).alias("message"),
    )
    violations = quality.package_violations(built, registers.organisations, registers.groups).unionByName(collisions)
    actions = None if published is None else packages.publish_diff(packages.digests(built), published)
    return Catalogue(resolved, scope, built, violations, notices, actions)


def ingest(
    spark: SparkSession, observations: DataFrame, ledger_path: str, run: str, spec: LedgerSpec | None = None
) -> DataFrame:
    """Append the observations whose token moved; returns per-source outcomes."""
    spec = spec or LedgerSpec()
    stored = read_table(spark, ledger_path).filter(F.col("ingest") != f"{run}-scrape")
    start = next_seq(stored)
    ordered = checkpointed(with_seq(observations, ["observed_at", "identity_key", "source_system"], start))
    moved = checkpointed(changed_rows(ordered, last_tokens(stored), spec))
    append_events(scrape_events(moved, task_field=spec.task_field), ledger_path, f"{run}-scrape")
    seen = ordered.join(moved.select("seq", F.lit(True).alias("changed")), "seq", "left")
    return seen.select(
        F.col("source_system").alias("source"), F.coalesce("changed", F.lit(False)).alias("changed"),
        F.lit(None).cast("string").alias("error"),
    )


def next_seq(events: DataFrame) -> int:
    """The first free ``seq``: one number, from the column's maximum."""
    top = events.agg(F.max("seq")).first()[0]
    return 0 if top is None else top + 1


def annotate(
    spark: SparkSession, annotations: DataFrame, rejects: DataFrame, ledger_path: str, run: str, now: Column,
    registers: Registers | None = None, spec: LedgerSpec | None = None,
) -> DataFrame:
    """Apply curator annotations and raise pin notices; returns the notices.

    With ``registers`` an annotation that names an owner or a task which is in none of them is refused, with a notice.
    """
    spec = spec or LedgerSpec()
    if registers is not None:
        annotations, refused = curation.check_annotations(annotations, registers.organisations, registers.groups, spec.task_field)
        rejects = rejects.select("message").unionByName(refused.select("message"))
    events = read_table(spark, ledger_path).filter(~F.col("ingest").isin(f"{run}-annotate", f"{run}-pins"))
    marked = annotations.withColumn(
        "fingerprint",
        curation.fingerprint(F.col("identity_key"), F.col("local"), F.col("actor"), F.col("note")),
    )
    planned = checkpointed(
        curation.plan_annotations(marked, events, curation.recorded_fingerprints(events))
    )
    applied = planned.filter(F.col("outcome") == "applied")
    fresh = with_seq(curation.annotation_events(applied, now).drop("seq"), ["observed_at", "identity_key"], next_seq(events))
    append_events(event_frame(fresh), ledger_path, f"{run}-annotate")
    events = read_table(spark, ledger_path).filter(F.col("ingest") != f"{run}-pins")
    pins = curation.pin_notices(fold(events, spec), events)
    append_events(event_frame(with_seq(pins.drop("seq"), ["observed_at", "identity_key"], next_seq(events))), ledger_path, f"{run}-pins")
    return curation.annotation_notices(planned, rejects)


@dataclass(frozen=True)
class Reconciliation:
    candidates: DataFrame
    plan: DataFrame
    already_merged: DataFrame
    proposals: DataFrame
    promotions: DataFrame


def reconcile_ledger(
    spark: SparkSession,
    ledger_path: str,
    registers: Registers,
    run: str,
    now: Column,
    spec: LedgerSpec | None = None,
    apply: bool = False,
) -> Reconciliation:
    """One reconciliation pass; without ``apply`` it only says what it would do."""
    spec = spec or LedgerSpec()
    mine = [f"{run}-promote", f"{run}-merge", f"{run}-propose"]
    events = read_table(spark, ledger_path).filter(~F.col("ingest").isin(mine))
    resolved = fold(events, spec)
    promoted = checkpointed(reconcile.promote_task_candidates(resolved, registers.groups, spec, now))
    if apply:
        numbered = with_seq(promoted.drop("seq"), ["identity_key"], next_seq(events))
        append_events(event_frame(numbered), ledger_path, f"{run}-promote")
        events = read_table(spark, ledger_path).filter(~F.col("ingest").isin(mine[1:]))
        resolved = fold(events, spec)
    candidates = checkpointed(reconcile.find_candidates(resolved, spec))
    automatic = candidates.filter("automatic")
    merged = reconcile.already_merged(automatic, resolved)
    plan = checkpointed(reconcile.plan_merges(automatic, merged))
    proposed = reconcile.merge_proposals(candidates).withColumn("observed_at", now)
    fresh = reconcile.new_notices(proposed, events)
    if apply:
        merges = reconcile.merge_events(
            plan, reconcile.record_urls(resolved), reconcile.link_url(resolved), now, next_seq(events)
        )
        append_events(merges, ledger_path, f"{run}-merge")
        events = read_table(spark, ledger_path).filter(F.col("ingest") != mine[2])
        numbered = with_seq(notice_events(fresh).drop("seq"), ["identity_key", "notice"], next_seq(events))
        append_events(event_frame(numbered), ledger_path, f"{run}-propose")
    return Reconciliation(candidates, plan, merged, fresh, promoted)


def write_proposals(result: Reconciliation, path: str) -> None:
    """The review table: proposals and the merges of this pass, replaced as a whole."""
    result.candidates.select(*reconcile.CANDIDATE).write.mode("overwrite").json(path)


def read_proposals(spark: SparkSession, path: str) -> DataFrame:
    """The review table as :func:`write_proposals` left it; none yet reads as empty."""
    ddl = "primary string, secondary string, kind string, confidence double, evidence string, automatic boolean"
    try:
        return spark.read.schema(ddl).json(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], ddl)


def run(
    spark: SparkSession,
    observations: DataFrame,
    ledger_path: str,
    records_path: str,
    report_path: str,
    registers: Registers,
    name: str,
    started_at: str,
    finished_at: str,
    spec: LedgerSpec | None = None,
) -> Catalogue | None:
    """Ingest, materialise, publish and report, in this order: the report says whether the records are out. It is written even
    when a stage fails; the failure is then raised, also where the report fails too.
    """
    outcomes = catalogue = failure = None
    try:
        outcomes = ingest(spark, observations, ledger_path, name, spec)
        names = KeyedTable(spark, f"{records_path}/names", "identity_key")
        catalogue = materialise(read_table(spark, ledger_path), registers, spec, names=names)
        rows = catalogue.packages.withColumn("digest", F.sha2(packages.record_json(catalogue.packages), 256))
        catalogue = replace(catalogue, actions=publish(records_table(spark, records_path), rows))
    except Exception as exc:
        failure, catalogue = exc, None
    try:
        _report(spark, outcomes, catalogue, report_path, started_at, finished_at)
    except Exception as exc:
        if failure is None:
            raise
        failure.add_note(f"the report failed too: {exc}")
    if failure is not None:
        raise failure
    return catalogue


def records_table(spark: SparkSession, path: str) -> KeyedTable:
    """The published records; ``read`` gives them as they are now."""
    return KeyedTable(spark, f"{path}/records", "name")


def _report(
    spark: SparkSession, outcomes: DataFrame | None, catalogue: Catalogue | None, path: str, started_at: str, finished_at: str
) -> None:
    done = catalogue is not None
    empty = lambda ddl: spark.createDataFrame([], ddl)
    report = reports.run_report(
        spark,
        reports.source_counters(outcomes if outcomes is not None else empty("source string, changed boolean, error string")),
        catalogue.actions if done else empty("name string, action string"),
        graph.scope_tally(catalogue.scope) if done else empty("inclusion_basis string, records bigint"),
        empty("hit boolean"),
        empty("cache_key string"),
        catalogue.violations if done else empty("record string"),
        started_at,
        finished_at,
    ).withColumn("ok", F.col("ok") & F.lit(done))
    reports.write_state(report, path)
