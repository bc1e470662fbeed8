"""Token counts of a corpus as an exact histogram of encoded lengths.

Documents are aggregated by length, and running sums over the lengths answer totals, quantiles and
truncated totals for every context limit without another pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.bpe import Tokenizer
from ledgerfold.llm.common import checkpointed, without

#: Lengths that are added up together.
SPAN = 1024


def encoded_length(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Append the number of tokens of each whole text; null counts as empty."""

    @F.pandas_udf("long")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = Tokenizer(path)
        for part in parts:
            yield pd.Series([len(t.encode(x or "")) for x in part], dtype="int64")

    return docs.select(*without(docs, out), of(F.col(text)).alias(out))


def running(hist: DataFrame, length: str, sums: dict[str, Column]) -> DataFrame:
    """Append sums over all rows of up to each ``length``; by spans, so no task sees all lengths."""
    spans = hist.withColumn("__span", F.floor(F.col(length) / SPAN))
    before = Window.orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    totals = spans.groupBy("__span").agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    starts = totals.select("__span", *[F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__{n}") for n in sums])
    inside = Window.partitionBy("__span").orderBy(length).rowsBetween(Window.unboundedPreceding, 0)
    rows = spans.select("*", *[F.sum(c).over(inside).alias(n) for n, c in sums.items()])
    out = rows.join(starts, "__span")
    return out.withColumns({n: F.col(n) + F.col(f"__{n}") for n in sums}).drop("__span", *[f"__{n}" for n in sums])


def length_histogram(lengths: DataFrame, length: str = "n_tokens") -> DataFrame:
    """One row per length that occurs: ``documents`` and ``tokens`` at it, ``documents_within`` and
    ``tokens_within`` up to it, the same beyond it (``_beyond``), and as a context limit its
    ``truncated_total``: the tokens that stay when every document is cut there. ``share_within`` is the
    share of documents that it cuts nothing of; the least length with a share of at least q is the
    q-quantile. An empty table gives no rows; null lengths count as 0.
    """
    hist = checkpointed(
        lengths.groupBy(F.coalesce(F.col(length), F.lit(0)).cast("long").alias("n_tokens")).agg(F.count("*").alias("documents"))
    ).withColumn("tokens", F.col("n_tokens") * F.col("documents"))
    all_of = hist.agg(F.sum("documents").alias("__documents"), F.sum("tokens").alias("__tokens"))
    sums = {"documents_within": F.col("documents"), "tokens_within": F.col("tokens")}
    out = running(hist, "n_tokens", sums).crossJoin(F.broadcast(all_of))  # one row
    return out.select(
        "n_tokens", "documents", "tokens", "documents_within", "tokens_within",
        (F.col("__documents") - F.col("documents_within")).alias("documents_beyond"),
        (F.col("__tokens") - F.col("tokens_within")).alias("tokens_beyond"),
        (F.col("tokens_within") + F.col("n_tokens") * (F.col("__documents") - F.col("documents_within"))).alias("truncated_total"),
        (F.col("documents_within") / F.col("__documents")).alias("share_within"),
    )


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """``context_limit``, ``documents_cut`` and ``truncated_total`` for any stated limits, from the histogram."""
    one = [
        F.struct(
            F.lit(x).cast("long").alias("context_limit"),
            F.coalesce(F.sum(F.when(F.col("n_tokens") > x, F.col("documents"))), F.lit(0)).alias("documents_cut"),
            F.coalesce(F.sum(F.least(F.col("n_tokens"), F.lit(x)) * F.col("documents")), F.lit(0)).alias("truncated_total"),
        ) for x in limits
    ]
    return hist.agg(F.array(*one).alias("x")).select(F.inline("x"))
