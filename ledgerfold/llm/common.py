"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.session import checkpointed

__all__ = ["WORD", "checkpointed", "give_back", "ordered_offsets", "without", "word_count"]


def without(df: DataFrame, *names: str) -> list[str]:
    """Columns of a frame but those of these names, told apart as the session tells them apart."""
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    gone = set(names) if exact else {n.lower() for n in names}
    return [c for c in df.columns if (c if exact else c.lower()) not in gone]

def give_back() -> None:
    """Return what this worker has freed to the system, for the same worker goes on to other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


#: A word: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: Bits of the order key that name a range of rows in ``ordered_offsets``.
RANGE_BITS = 10


def ordered_offsets(df: DataFrame, key: str, order: str, size: Column, out: str, ties: list[str]) -> DataFrame:
    """Running total of ``size`` before each row of its ``key``, in the order of the long column
    ``order`` (evenly spread values, such as a hash), then of ``ties``.

    No key is gathered in one task: rows are totalled by ranges of ``order``, the ranges (at most
    ``2 ** RANGE_BITS`` a key) are totalled in order, and rows are totalled within their range. The
    result does not depend on how many ranges there are. ``key`` must not be null. ``df`` is read twice: hand
    in a narrow frame that is stored or cheap.
    """
    part = f"__range_{out}"
    ranged = df.withColumn(part, F.shiftright(F.col(order), 64 - RANGE_BITS))
    totals = ranged.groupBy(key, part).agg(F.sum(size).alias("__total"))
    before = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col(key).alias("__key"), F.col(part).alias("__part"),
        F.coalesce(F.sum("__total").over(before), F.lit(0)).cast("long").alias("__start"),
    )
    inside = Window.partitionBy(key, part).orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumn(out, F.coalesce(F.sum(size).over(inside), F.lit(0)).cast("long"))
    joined = rows.join(starts, (F.col(key) == F.col("__key")) & (F.col(part) == F.col("__part")), "left")
    return joined.withColumn(out, F.col(out) + F.col("__start")).drop(part, "__key", "__part", "__start")
