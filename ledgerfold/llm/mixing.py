"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's documents are put in a hashed order and read round and round as one stream of words,
cut into blocks of equal length. Slots of the mix are dealt to sources by the golden-ratio sequence
mapped through the cumulative targets; the k-th slot of a source takes its k-th block. The sequence
keeps each source within a few slots of its share at every point of the mix; blocks that a target still
wants when the slots are dealt come last, and the last block of a source is cut at the target.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.common import checkpointed, ordered_offsets, word_count
from ledgerfold.session import small_side

#: Weights of sources in code point order, again and again.
WEIGHTS = (1, 2, 3)
#: Words that the mix takes are at most so many times those that a source has.
MOST_PASSES = 3
BLOCK_WORDS = 1024
#: Fixed value: the fraction of the golden ratio.
GOLDEN = Decimal("0.61803398874989485")
#: Cells of the unit interval that bring a slot to the few sources it may fall to.
CELLS = 4096


def hashed_order(key: Column) -> Column:
    """60 bits of a digest as a long of evenly spread values."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long") * 8


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = MOST_PASSES) -> DataFrame:
    """One row per source: place, weight, size, ``target`` and the whole ``budget`` of words.

    Targets share the total by weight. One that exceeds ``passes`` times its source stops there, and the
    excess goes to the others by weight until none exceeds. Sources whose size per weight is least stop
    first, so one pass in that order finds them: what is left at the first one that doesn't stop is shared by
    the rest. There is one row per source here, not per document.
    """
    d = "decimal(38,0)"
    ranked = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn(
        "place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * passes)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    walked = capped.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left"),
        F.sum("weight").over(onward).alias("weights_left"),
    ).withColumn("stops", F.col("cap").cast(d) * F.col("weights_left") <= F.col("weight").cast(d) * F.col("left"))
    open_left = F.max(F.when(~F.col("stops"), F.col("left"))).over(everything)
    open_weights = F.max(F.when(~F.col("stops"), F.col("weights_left"))).over(everything)
    target = F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(
        F.col("weight") * open_left.cast("double") / open_weights
    )
    return walked.select("source", "place", "weight", "source_size", "cap", target.alias("target")).withColumn(
        "budget", F.least(F.floor(F.col("target") + 0.5), F.col("cap")).cast("long")
    ).drop("cap")


def slots(spark, plan: DataFrame, block: int) -> DataFrame:
    """``place``, ``block`` and ``slot``: which block of which source each slot of the mix takes."""
    ends = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    total = plan.agg(F.coalesce(F.sum("budget"), F.lit(0))).first()[0]
    n = -(-total // block)
    shares = plan.select("place", "budget", F.sum("budget").over(ends).alias("end")).select(
        "place", ((F.col("end") - F.col("budget")) / max(1, total)).alias("low"), (F.col("end") / max(1, total)).alias("high")
    )
    cells = shares.filter("high > low").withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.floor(F.col("high") * CELLS)))
    )
    point = F.pmod((F.col("id") + 1).cast("decimal(19,0)") * F.lit(GOLDEN), F.lit(Decimal(1))).cast("double")
    dealt = (
        spark.range(n)
        .select(F.col("id").alias("slot"), point.alias("point"))
        .withColumn("cell", F.floor(F.col("point") * CELLS))
        .join(small_side(cells), "cell")
        .filter("point >= low and point < high")
        .select("place", "slot", (F.col("slot") * ((1 << 62) // max(1, n))).alias("__at"))
    )
    return ordered_offsets(dealt, "place", "__at", F.lit(1), "block", []).drop("__at")


def schedule(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = MOST_PASSES, block: int = BLOCK_WORDS,
    text: str = "text", source: str = "source", doc_id: str = "doc_id",
) -> tuple[DataFrame, DataFrame]:
    """The mix, and the documents it is made of.

    The mix has a row per piece: ``slot`` (order in the mix; null for the blocks that come last), ``place``
    and ``block`` of the source, ``doc_id``, ``at`` (place of the document in the source's stream),
    ``from_word``, ``words`` and ``turn`` (how often the stream was read before). The documents have ``doc_id``,
    ``source``, ``size``, ``at``, ``place``, ``source_size``, ``target`` and ``budget``.

    Null and empty texts have size 0 and are never taken; a null source is a source, after the others. Rows
    with equal ids are taken one by one. An empty table gives an empty mix. Other columns are not used.
    """
    spark = docs.sparkSession
    base = checkpointed(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        hashed_order(F.col(doc_id)).alias("__order"),
    ))
    plan = checkpointed(targets(base, weights, passes))
    ours = plan.withColumnRenamed("source", "__source")
    known = base.join(small_side(ours), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    placed = ordered_offsets(known, "place", "__order", F.col("size"), "at", ["doc_id", "size"]).drop("__order")
    placed = checkpointed(placed)
    turns = placed.filter("size > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    spans = turns.withColumn("low", F.col("at") + F.col("turn") * F.col("source_size")).withColumn(
        "high", F.least(F.col("low") + F.col("size"), F.col("budget"))
    ).filter("low < high")
    pieces = spans.withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("low") / block), F.floor((F.col("high") - 1) / block)))
    )
    first = F.greatest(F.col("low"), F.col("block") * block)
    cut = pieces.select(
        "place", "block", "doc_id", "size", "at", "turn",
        (first - F.col("low")).alias("from_word"),
        (F.least(F.col("high"), (F.col("block") + 1) * block) - first).alias("words"),
    )
    return cut.join(slots(spark, plan, block), ["place", "block"], "left"), placed


def taken(mix: DataFrame, placed: DataFrame) -> DataFrame:
    """Documents with the words that the mix takes of each, repeats counted, and ``copies``: how often
    the mix takes its first word, so whole documents by it come to nearly the same shares; further ``first_slot``, the first slot of the
    mix that shows some of it (null where only the blocks that come last do), and ``n_slots``, how many slots do.

    A place in a stream belongs to one document with words, so that is what pieces are added up by.
    """
    sums = mix.groupBy("place", "at").agg(
        F.sum("words").alias("taken"), F.sum((F.col("from_word") == 0).cast("int")).alias("copies"),
        F.min("slot").alias("first_slot"), F.count_distinct("slot").alias("n_slots"),
    )
    has = placed.filter("size > 0").join(sums, ["place", "at"], "left")
    nothing = F.lit(0)
    none = placed.filter("size = 0").select(
        "*", nothing.alias("taken"), nothing.alias("copies"), F.lit(None).cast("long").alias("first_slot"), nothing.alias("n_slots"))
    return has.unionByName(none).withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("taken", "copies", "n_slots")}
    )
