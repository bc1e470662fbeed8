"""Documents to shards by a hierarchical weighted hash tree.

A row descends region, rack and shard. At each level every child draws ``-ln(u) / weight`` with ``u``
hashed from the key and the child's place, and the least draw wins, so a child gets rows in proportion
to its weight and a change of weights moves rows only into or out of the subtrees whose weights
changed. A shard added later draws once at the root: what it wins leaves its old shard for the new
one, and all other rows descend as before, so growth moves rows into the new shard alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import checkpointed, ordered_offsets, without


@dataclass(frozen=True)
class ShardTree:
    """Weights of the founding shards by region and rack, and of shards added since, in their order.

    Shards are numbered through regions and racks, then in the order of addition.
    """

    regions: tuple[tuple[tuple[float, ...], ...], ...]
    added: tuple[float, ...] = field(default=())

    @classmethod
    def even(cls, regions: int, racks: int, shards: int) -> ShardTree:
        return cls((((1.0,) * shards,) * racks,) * regions)

    def grown(self, weight: float = 1.0) -> ShardTree:
        return replace(self, added=(*self.added, weight))

    @property
    def founding(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)

    @property
    def shards(self) -> int:
        return self.founding + len(self.added)


def winner(weights: Column, key: Column, *place: Column) -> Column:
    """Position of the child with the least draw; a weight of 0 never wins against another."""

    def draw(weight: Column, i: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, *place, i), 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct(F.when(weight > 0, -F.ln(u) / weight).otherwise(F.lit(float("inf"))).alias("at"), i.alias("i"))

    return F.array_min(F.transform(weights, draw))["i"]


def nested(values: list) -> Column:
    return F.array(*[nested(v) if isinstance(v, list) else F.lit(v) for v in values])


def assign(df: DataFrame, tree: ShardTree, key: str = "doc_id", shard: str = "shard") -> DataFrame:
    """Append the shard of each row as an int; it depends on the key and the tree alone.

    Rows with equal keys, null among them, share a shard. A column named ``shard`` is replaced.
    """
    first, at = [], 0
    for region in tree.regions:
        first.append([])
        for rack in region:
            first[-1].append(at)
            at += len(rack)
    region_weights = [float(sum(map(sum, region))) for region in tree.regions]
    rack_weights = [[float(sum(rack)) for rack in region] for region in tree.regions]
    shard_weights = [[[float(w) for w in rack] for rack in region] for region in tree.regions]
    k, n = F.col(key), len(tree.regions)
    out = df.withColumn("__top", winner(nested(region_weights + [float(w) for w in tree.added]), k, F.lit("root")))
    # an added shard ends the descent; the lower levels are then not looked at
    inner, region = F.col("__top") < n, F.col("__top") + 1
    out = out.withColumn(
        "__rack", F.when(inner, winner(F.element_at(nested(rack_weights), region), k, F.lit("rack"), F.col("__top")))
    )
    leaf = winner(
        F.element_at(F.element_at(nested(shard_weights), region), F.col("__rack") + 1),
        k, F.lit("shard"), F.col("__top"), F.col("__rack"),
    )
    start = F.element_at(F.element_at(nested(first), region), F.col("__rack") + 1)
    placed = F.when(inner, start + leaf).otherwise(F.col("__top") - n + tree.founding).cast("int")
    return out.withColumn("__shard", placed).select(
        *without(df, shard), F.col("__shard").alias(shard)
    )


def measure(docs: DataFrame, text: str = "text", overhead: int = 16) -> DataFrame:
    """Append ``size`` (UTF-8 bytes and a fixed overhead) and ``text_crc32``; null counts as empty."""
    body = F.coalesce(F.col(text), F.lit(""))
    kept = without(docs, "size", "text_crc32")
    return docs.select(
        *kept,
        (F.octet_length(body) + overhead).cast("long").alias("size"),
        F.crc32(F.encode(body, "utf-8")).alias("text_crc32"),
    )


def numbered(df: DataFrame, key: str = "doc_id", shard: str = "shard", slot: str = "slot", ties: tuple[str, ...] = ()) -> DataFrame:
    """Append a gapless place in each shard, from 0, in hashed order of the key.

    Rows of equal key and ties are interchangeable. No shard is gathered in one task. The frame is
    stored once, so leave texts out of it.
    """
    out = checkpointed(df.withColumn("__order", F.xxhash64(F.col(key), *[F.col(t) for t in ties])))
    return ordered_offsets(out, shard, "__order", F.lit(1), slot, [key, *ties]).drop("__order")
