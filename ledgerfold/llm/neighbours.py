"""What both neighbour searches share: equal points are searched once.

Rows with the same value (a code, a vector) are kept as one point with its least ``k + 1`` ids: ties go to
the smaller id, so no other copy can be among the nearest ``k`` of anything, its own row left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def points(rows: DataFrame, value: str, k: int) -> DataFrame:
    """``value``, ``first_id``, ``n_ids`` and ``ids`` (sorted) from rows of ``id`` and ``value``.

    The least ids of a value are picked before and after the shuffle, so a value that a third of the
    rows share is no burden.
    """
    least = Window.partitionBy(value).orderBy("id")
    few = rows.withColumn("__n", F.row_number().over(least)).filter(F.col("__n") <= k + 1)
    grouped = few.groupBy(value).agg(F.sort_array(F.collect_set("id")).alias("ids"))
    return grouped.select(value, F.element_at("ids", 1).alias("first_id"), F.size("ids").alias("n_ids"), "ids")


def to_rows(best: DataFrame, targets: DataFrame, queries: DataFrame, key: list[str], measure: str, order: Column, k: int) -> DataFrame:
    """Nearest rows of each query row from the nearest points of each query point.

    ``best`` has the query point's ``key`` prefixed ``q_``, the found point's ``key`` and ``measure``;
    ``targets`` has ``key`` and ``ids``; ``queries`` has ``query_id`` and ``q_`` columns. A query's own id
    is left out. Returns ``query_id``, ``rank``, ``id`` and ``measure``.
    """
    point = [f"q_{c}" for c in key]
    ranked = Window.partitionBy(*point).orderBy(order, "id")
    near = (
        best.join(targets.select(*key, "ids"), key).withColumn("id", F.explode("ids"))
        .withColumn("__n", F.row_number().over(ranked)).filter(F.col("__n") <= k + 1).select(*point, "id", measure)
    )
    mine = Window.partitionBy("query_id").orderBy(order, "id")
    return (
        queries.join(near, point).filter("id <> query_id")
        .withColumn("rank", F.row_number().over(mine)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "id", measure)
    )
