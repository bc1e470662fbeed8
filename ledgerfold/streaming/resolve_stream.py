"""Keeping resolved records and their scope current as events arrive."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerfold.operators.graph import alias_owner, decide_scope, stated_citations, stated_names
from ledgerfold.operators.ledger import BUCKETS, read_table
from ledgerfold.operators.resolve import resolve, system_state
from ledgerfold.session import BROADCAST_ROWS, checkpointed, empty_frame
from ledgerfold.sources.keyed import KeyedTable
from ledgerfold.spec import LedgerSpec

WRITER = "resolve"


def resolved_table(spark: SparkSession, store: str, buckets: int = BUCKETS) -> KeyedTable:
    return KeyedTable(spark, f"{store}/resolved", "identity_key", buckets)


def refresh_identities(
    spark: SparkSession, touched: DataFrame, ledger_path: str, store: str, batch: int,
    spec: LedgerSpec | None = None, buckets: int = BUCKETS, few_keys: int = BROADCAST_ROWS,
) -> DataFrame:
    """Re-fold the touched identities from the ledger and replace their rows; returns these, stored.

    The fold orders by observation time, not arrival, so an event that comes late
    simply takes its place; nothing is dropped behind a watermark. The state per system is stored, so the events of the
    touched buckets are aggregated once. Few touched identities pick their events first; many pick their states, for
    that join would move every event.
    """
    spec = spec or LedgerSpec()
    table = resolved_table(spark, store, buckets)
    keys = checkpointed(touched.select("identity_key").distinct())
    held = read_table(spark, ledger_path).filter(F.col("bucket").isin(table.buckets_of(keys)))
    few = keys.count() <= few_keys
    events = held.join(F.broadcast(keys) if few else keys, "identity_key", "left_semi")
    state = checkpointed(system_state(events if few else held, spec))
    if not few:
        state = state.join(keys, "identity_key", "left_semi")
    fresh = checkpointed(resolve(events, spec, state))
    table.merge(fresh, WRITER, batch)
    return fresh


class CitationGraph:
    """What records state about citations, kept so that a batch costs what it touches.

    ``claims`` and ``stated`` are dealt by alias: who is known by it, and who cites it. ``edges`` counts for both ends of every
    citation the statements that make it, so an edge goes with its last statement. ``scope`` is the decision per
    record. A change of a record's statements counts at the alias's owner before and after; where the owner of an
    alias changes, all who state it are moved from the one to the other. Each table is read as it was before
    the batch, so a batch that is repeated after a crash between two tables comes to the same end.
    """

    def __init__(self, spark: SparkSession, store: str, generic_routes: list[str], task_field: str = "task", buckets: int = BUCKETS):
        self.spark, self.generic, self.task_field = spark, generic_routes, task_field
        at = lambda name, key, by=None: KeyedTable(spark, f"{store}/{name}", key, buckets, by)
        self.claims, self.stated = at("claims", "id", "alias"), at("stated", "id", "alias")
        self.said, self.edges, self.scope = at("said", "identity_key"), at("edges", "id", "node"), at("scope", "identity_key")

    def _was(self, table: KeyedTable, batch: int, at: DataFrame, column: str, schema: str) -> DataFrame:
        """Rows of a table before the batch whose ``column`` is among those of ``at``."""
        entry = table.before(WRITER, batch)
        if entry is None:
            return empty_frame(self.spark, StructType.fromDDL(schema))
        keys = at.select(column).distinct()
        return table.read(entry, table.buckets_of(at.withColumnRenamed(column, table.by))).join(keys, column, "left_semi")

    def update(self, fresh: DataFrame, resolved: KeyedTable, batch: int) -> None:
        """Take in the new states of the touched records (``fresh``) and decide the scope of all whose grounds changed."""
        line = lambda *c: F.concat_ws("\x1f", *c)
        said = fresh.select("identity_key").join(
            stated_citations(fresh).distinct().groupBy("identity_key").agg(F.collect_set(F.struct("alias", "outward")).alias("cites")), "identity_key", "left"
        ).join(stated_names(fresh).groupBy("identity_key").agg(F.collect_set(F.struct("alias", "own")).alias("names")), "identity_key", "left")
        none = {"cites": "array<struct<alias:string,outward:boolean>>", "names": "array<struct<alias:string,own:boolean>>"}
        empty = {c: F.coalesce(c, F.array().cast(t)) for c, t in none.items()}
        said = checkpointed(said.withColumns(empty))
        was = self._was(self.said, batch, said, "identity_key", "identity_key string, " + ", ".join(f"{c} {t}" for c, t in none.items()))
        old = {c: F.coalesce(f"_{c}", F.array().cast(t)) for c, t in none.items()}
        both = said.join(was.withColumnsRenamed({c: f"_{c}" for c in none}), "identity_key", "left").withColumns({f"_{c}": v for c, v in old.items()})
        changed = lambda c: both.select("identity_key", F.explode(F.concat(
            F.transform(F.array_except(c, f"_{c}"), lambda x: F.struct(x.alias("x"), F.lit(1).alias("d"))),
            F.transform(F.array_except(f"_{c}", c), lambda x: F.struct(x.alias("x"), F.lit(-1).alias("d"))),
        )).alias("c")).select("identity_key", "c.x.*", "c.d")
        names, cites = checkpointed(changed("names")), checkpointed(changed("cites"))

        # owners of all aliases that matter, before and after
        asked = names.select("alias").union(cites.select("alias")).distinct()
        claims = "id string, alias string, identity_key string, own boolean, held int"
        before = self._was(self.claims, batch, asked, "alias", claims).filter("held > 0")
        moved = names.withColumn("id", line("alias", "identity_key", F.col("own").cast("string")))
        after = before.join(moved.filter("d < 0").select("id"), "id", "left_anti").unionByName(
            moved.filter("d > 0").select("id", "alias", "identity_key", "own", F.lit(1).alias("held")))
        owners = checkpointed(alias_owner(before).withColumnRenamed("identity_key", "was").join(
            alias_owner(after).withColumnRenamed("identity_key", "now"), "alias", "full_outer"))
        rows = "id string, alias string, identity_key string, outward boolean, held int"
        turned = owners.filter(~F.col("was").eqNullSafe(F.col("now"))).select("alias")
        by_alias = self._was(self.stated, batch, checkpointed(turned), "alias", rows).filter("held > 0")
        kept = by_alias.join(cites.filter("d < 0").select("alias", "identity_key", "outward"), ["alias", "identity_key", "outward"], "left_anti")
        flows = (
            cites.filter("d < 0").select("identity_key", "alias", "outward", F.lit(1).alias("out"), F.lit(0).alias("into"))
            .union(cites.filter("d > 0").select("identity_key", "alias", "outward", F.lit(0), F.lit(1)))
            .union(kept.select("identity_key", "alias", "outward", F.lit(1), F.lit(1)))
        ).join(owners, "alias")
        ends = F.array(F.struct(F.col("was").alias("other"), (-F.col("out")).alias("d")), F.struct(F.col("now").alias("other"), F.col("into").alias("d")))
        counted = flows.select("identity_key", "outward", F.inline(ends)).filter((F.col("d") != 0) & F.col("other").isNotNull() & (F.col("other") != F.col("identity_key")))
        src = F.when(F.col("outward"), F.col("identity_key")).otherwise(F.col("other"))
        dst = F.when(F.col("outward"), F.col("other")).otherwise(F.col("identity_key"))
        delta = counted.groupBy(src.alias("src"), dst.alias("dst")).agg(F.sum("d").alias("d")).filter("d <> 0")
        delta = checkpointed(delta.select(F.inline(F.array(
            F.struct(F.col("src").alias("node"), F.col("dst").alias("other"), F.lit(True).alias("cites"), "d"),
            F.struct(F.col("dst").alias("node"), F.col("src").alias("other"), F.lit(False).alias("cites"), "d"),
        ))).withColumn("id", line("node", "other", F.col("cites").cast("string"))))

        touched = checkpointed(fresh.select("identity_key").union(delta.select("node")).distinct())
        edge = "id string, node string, other string, cites boolean, n bigint"
        held = self._was(self.edges, batch, touched.withColumnRenamed("identity_key", "node"), "node", edge)
        edges = checkpointed(held.unionByName(delta.withColumnRenamed("d", "n")).groupBy("id", "node", "other", "cites").agg(F.sum("n").alias("n")))
        standing = edges.filter("n > 0").select(
            F.when(F.col("cites"), F.col("node")).otherwise(F.col("other")).alias("src"),
            F.when(F.col("cites"), F.col("other")).otherwise(F.col("node")).alias("dst")).distinct()  # one row, whichever ends were touched
        records = resolved.read(buckets=resolved.buckets_of(touched)).join(touched, "identity_key", "left_semi")
        scope = checkpointed(decide_scope(records, standing, self.generic, self.task_field))

        self.claims.merge(checkpointed(moved.select("id", "alias", "identity_key", "own", F.when(F.col("d") > 0, 1).otherwise(0).alias("held"))), WRITER, batch)
        line_id = line("alias", "identity_key", F.col("outward").cast("string"))
        self.stated.merge(checkpointed(cites.select(line_id.alias("id"), "alias", "identity_key", "outward", F.when(F.col("d") > 0, 1).otherwise(0).alias("held"))), WRITER, batch)
        self.edges.merge(checkpointed(edges.join(delta.select("id"), "id", "left_semi")), WRITER, batch)
        self.scope.merge(scope, WRITER, batch)
        self.said.merge(said, WRITER, batch)

    def standing_edges(self) -> DataFrame:
        """``(src, dst, n)``: every citation and the number of statements that make it."""
        return self.edges.read().filter("cites AND n > 0").select(F.col("node").alias("src"), F.col("other").alias("dst"), "n")


def resolve_continuously(
    events: DataFrame, ledger_path: str, store: str, checkpoint: str, spec: LedgerSpec | None = None,
    buckets: int = BUCKETS, generic_routes: list[str] | None = None,
) -> StreamingQuery:
    """Follow a stream of appended events and keep the resolved table current.

    ``buckets`` is the number the ledger was written with. With ``generic_routes`` the citation graph and every record's
    scope are kept too.
    """
    spec = spec or LedgerSpec()

    def one(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        touched = batch.select("identity_key").distinct().persist(StorageLevel.MEMORY_AND_DISK)
        fresh = refresh_identities(spark, touched, ledger_path, store, batch_id, spec, buckets)
        if generic_routes is not None:
            graph = CitationGraph(spark, f"{store}/graph", generic_routes, spec.task_field, buckets)
            graph.update(fresh, resolved_table(spark, store, buckets), batch_id)
        touched.unpersist()

    return (
        events.writeStream.foreachBatch(one)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def resolved_now(spark: SparkSession, store: str, buckets: int = BUCKETS) -> DataFrame | None:
    return resolved_table(spark, store, buckets).read()
