"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: A key with more detail rows than this counts as hot. At most ``rows / HOT_ROWS``
#: keys can be, which bounds the one table that is broadcast here.
HOT_ROWS = 1_000_000
#: Rows of one key that meet others in one task, where both sides may have many.
BLOCK_ROWS = 2_000
#: Parts a hot key's rows are spread over.
SALTS = 1024


def per_key_join(
    detail: DataFrame,
    per_key: DataFrame,
    keys: list[str],
    how: str = "inner",
    rows: str = "rows",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join detail rows with a one-row-per-key frame, whatever share a key has.

    ``per_key`` carries the number of detail rows in column ``rows``. A hot key's
    detail rows are spread over salts by a hash of the row, and its one row is
    repeated for every salt; all other keys have one salt. Rows with a NULL key
    match nothing and are spread too.
    """
    hot = F.broadcast(per_key.filter(F.col(rows) > hot_rows).select(*keys, F.lit(True).alias("_hot")))
    hashed = [
        f.name for f in detail.schema.fields
        if not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))
    ]
    part = F.pmod(F.xxhash64(*hashed), F.lit(SALTS)).cast("int")
    spread = F.coalesce("_hot", F.lit(False))
    for key in keys:
        spread = spread | F.col(key).isNull()
    left = detail.join(hot, keys, "left").withColumn("_salt", F.when(spread, part).otherwise(0)).drop("_hot")
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = per_key.drop(rows).join(hot, keys, "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def lookup_join(
    detail: DataFrame, unique: DataFrame, keys: list[str], how: str = "inner", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Join detail rows with any table that has one row per key.

    The detail rows per key are counted first, with map-side combining.
    """
    counts = detail.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return per_key_join(detail, unique.join(counts, keys), keys, how, hot_rows=hot_rows)


def gridded(
    left: DataFrame, right: DataFrame, keys: list[str], left_row: str, right_row: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """An equi-join of two tables that may both have very many rows of one key.

    The rows of such a key are dealt into blocks, and every block of the left meets every block of the right in a
    cell of its own; ``left_row`` and ``right_row`` name what rows are dealt by. A key below ``block_rows`` on both sides
    has one cell. At most rows / block_rows keys are above it.
    """
    def many(rows: DataFrame, n: str) -> DataFrame:
        counted = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(n))
        return counted.filter(F.col(n) > 1)

    one = F.lit(1)
    grid = many(left, "_l").join(many(right, "_r"), keys, "full_outer").select(
        *keys, F.coalesce("_l", one).alias("_l"), F.coalesce("_r", one).alias("_r"))

    def dealt(rows: DataFrame, row: str, own: str, other: str) -> DataFrame:
        shaped = rows.join(grid, keys, "left").withColumns({"_l": F.coalesce("_l", one), "_r": F.coalesce("_r", one)})
        mine = shaped.withColumn(f"{own}_at", F.pmod(F.xxhash64(row), F.col(own)).cast("int"))
        return mine.withColumn(f"{other}_at", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("_l", "_r")

    cell = ["_l_at", "_r_at"]
    return dealt(left, left_row, "_l", "_r").join(dealt(right, right_row, "_r", "_l"), [*keys, *cell]).drop(*cell)


def previous_value(
    rows: DataFrame, keys: list[str], segment: Column, order: list[str], value: str
) -> DataFrame:
    """Add ``previous`` and ``has_previous``: the value one row earlier per key.

    A plain ``lag`` over the key would send a hot key's whole history to one task.
    Here a history is cut into ordered segments: rows look back inside their
    segment, and only the first row of each segment looks at the last value of
    the segment before, through a table with one row per key and segment.
    """
    cut = rows.withColumn("_segment", segment)
    inside = W.partitionBy(*keys, "_segment").orderBy(*order)
    local = (
        cut.withColumn("_at", F.row_number().over(inside))
        .withColumn("_lag", F.lag(value).over(inside))
    )
    ends = local.groupBy(*keys, "_segment").agg(F.max_by(F.struct(value), "_at").alias("_end"))
    across = W.partitionBy(*keys).orderBy("_segment")
    ends = ends.select(*keys, "_segment", F.lag("_end").over(across).alias("_before"))
    joined = local.join(ends, [*keys, "_segment"], "left")
    first = F.col("_at") == 1
    return joined.select(
        *[F.col(c) for c in rows.columns],
        F.when(first, F.col(f"_before.{value}")).otherwise(F.col("_lag")).alias("previous"),
        (~first | F.col("_before").isNotNull()).alias("has_previous"),
    )
