"""Observation streams into the ledger, appending only what changed."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ledgerfold.operators.extraction import upsert_queue
from ledgerfold.operators.ledger import BUCKETS, append_events, log_order, read_table, scrape_events
from ledgerfold.sources.keyed import KeyedTable
from ledgerfold.spec import LedgerSpec

#: Moves of one key that are remembered; a row that comes later than these is compared with the oldest of them.
REMEMBERED = 16
KEY = ["identity_key", "source_system"]
MOVES = "observed_at array<string>, seq array<long>, source_key array<string>"
#: Fixed value: the state store that keyed state of this kind needs.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def without_replays(observations: DataFrame, time: str, late: str = "1 hour") -> DataFrame:
    """Drop rows the transport delivered twice.

    The observation time is part of the key: a token that goes k1, k2, k1 is three
    real changes, and only the same observation seen again is a replay.
    """
    return observations.withWatermark(time, late).dropDuplicatesWithinWatermark(
        ["identity_key", "source_system", "source_key", "observed_at"]
    )


def place_moves(known: list[tuple], rows: list[tuple], remembered: int = REMEMBERED) -> tuple[list[bool], list[tuple]]:
    """Which of ``rows`` (time, place, token; sorted) differ from the one before them in time, and the moves known after.

    ``known`` are the moves so far, sorted. A row that comes late takes its place among them. A row older than all is
    compared with the oldest, for what came before that is forgotten.
    """
    known, moved = list(known), []
    for row in rows:
        at = bisect_right(known, row[:2], key=lambda k: k[:2])
        before = known[max(at - 1, 0)] if known else None
        differs = before is None or before[2] != row[2]
        moved.append(differs)
        if differs:
            known.insert(at, row)
    return moved, known[-remembered:]


class Moves(StatefulProcessor):
    """Last moves of every (identity, system); lets through the rows whose token moved.

    A key has few rows in a batch, so rows come one by one, not as a frame per key, and its moves are one value: they are
    read and written once.
    """

    def __init__(self, forget_after_ms: int | None = None, remembered: int = REMEMBERED):
        self.ttl, self.remembered = forget_after_ms, remembered

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("moves", MOVES, ttlDurationMs=self.ttl) if self.ttl else handle.getValueState("moves", MOVES)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802
        mine = sorted(rows, key=lambda r: (r["observed_at"], r["seq"]))
        if not mine:  # a key that only the ledger knows
            return
        held = self.state.get()
        known = list(zip(*held, strict=True)) if held else []
        moved, known = place_moves(known, [(r["observed_at"], r["seq"], r["source_key"]) for r in mine], self.remembered)
        self.state.update(tuple(list(c) for c in zip(*known, strict=True)))
        for differs, r in zip(moved, mine, strict=True):
            if differs:
                yield Row(row=r["row"])

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:  # noqa: N802, N803
        self.state.update(([initialState["observed_at"]], [initialState["seq"]], [initialState["source_key"]]))

    def close(self) -> None:
        pass


def append_on_change(
    observations: DataFrame, ledger_path: str, checkpoint: str, spec: LedgerSpec | None = None,
    buckets: int = BUCKETS, forget_after_ms: int | None = None,
) -> StreamingQuery:
    """Append the observations of a stream whose token moved.

    ``observations`` carries ``seq``, its place in the transport. The last moves of each identity and system
    are keyed state, begun from the ledger by the first batch; later batches read no ledger. An append is
    named by its batch, so a retry replaces itself. Rows of one key are ordered in one task per batch, so the trigger bounds what
    a hot identity costs. With ``forget_after_ms`` a key that nothing was seen of for so long is forgotten, and its next
    observation counts as a change.
    """
    spec = spec or LedgerSpec()
    spark = observations.sparkSession
    schema = observations.schema
    last = (
        read_table(spark, ledger_path).filter(F.col("event_type") == "scraped").groupBy(*KEY)
        .agg(F.max_by(F.struct("observed_at", "seq", "source_key"), log_order()).alias("m")).select(*KEY, "m.*")
    )
    rows = observations.select(*KEY, "observed_at", F.col("seq").cast("long").alias("seq"), "source_key", F.to_json(F.struct("*")).alias("row"))
    moved = rows.groupBy(*KEY).transformWithState(
        Moves(forget_after_ms), "row string", "append", "processingTime" if forget_after_ms else "none", initialState=last.groupBy(*KEY)
    ).select(F.from_json("row", schema).alias("r")).select("r.*")

    def one(batch: DataFrame, batch_id: int) -> None:
        append_events(scrape_events(batch, task_field=spec.task_field), ledger_path, f"stream-{batch_id}", buckets)

    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, STATE_STORE)
    try:
        return moved.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(provider, before)


def keep_queue(queued: DataFrame, path: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Maintain the pending-extraction queue from a stream of cache misses; :func:`queue_table` reads it."""
    table = queue_table(queued, path, buckets)

    def one(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        rows = batch.select("seq", "url", "cache_key", "reason", "queued_at", F.col("seq").alias("reason_seq"))
        old = table.read(table.before("queue", batch_id), table.buckets_of(batch)) if table.versions() else None
        if old is not None:
            rows = rows.unionByName(old.select(F.col("queue_pos").alias("seq"), "url", "cache_key", "reason", "queued_at", "reason_seq"))
        table.merge(upsert_queue(rows).persist(), "queue", batch_id)
        batch.unpersist()

    return queued.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start()


def queue_table(frame: DataFrame, path: str, buckets: int = BUCKETS) -> KeyedTable:
    return KeyedTable(frame.sparkSession, path, "cache_key", buckets)
