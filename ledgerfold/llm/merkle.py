"""A dataset manifest of hash trees, built with column expressions.

Leaves are ranked inside their group (a source). Every aligned block of ``16 ** 3`` of them is one row that
keeps each level of its subtree as one string of hex digests side by side: a parent is the hash of a substring
of sixteen digests, and the siblings of a node are the substrings on its two flanks. The roots of the blocks are the
leaves of the next, much smaller, tree of the same kind, until a group has one root; the roots of the groups form a tree
in the same way. A proof is the list of flanks from a leaf to the root, and folding a digest through it gives the
root again only if the digest is the one that was stored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.common import checkpointed

#: Children of a node, hex digits of a digest, levels of a block and leaves of it.
ARITY, DIGITS, LEVELS = 16, 64, 3
BLOCK = ARITY**LEVELS
RUN = ARITY * DIGITS


@dataclass(frozen=True)
class Manifest:
    """Stored tables of one tree: ``blocks`` (group, block, level strings, its leaves), ``paths`` (flanks from each block's root to the
    tree's) and ``root`` (one row, or none for an empty table)."""

    blocks: DataFrame
    paths: DataFrame
    root: DataFrame


def leaf_digest(*fields: Column) -> Column:
    """Hash of the fields in order: ``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    said = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s), F.lit(":"), s)) for s in said]), 256)


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Append ``pos`` (gapless from 0 in each group) and ``n`` (rows of the group).

    Rows are dealt by ranges of group and order, so a group of any size is spread; a place is the number of rows in
    the ranges before and the rank inside the range. The ranges are stored, for their borders are sampled.
    """
    placed = checkpointed(rows.repartitionByRange(group, *order).withColumn("part", F.spark_partition_id()))
    whole = Window.partitionBy("of")
    before = whole.orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(F.col(group).alias("of"), F.col("part").alias("nth")).agg(F.count("*").alias("m"))
    starts = counts.select("of", "nth", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("start"), F.sum("m").over(whole).alias("n"))
    inside = Window.partitionBy(group, "part").orderBy(*order)
    found = placed.withColumn("pos", F.row_number().over(inside) - 1)
    joined = found.join(starts, F.col(group).eqNullSafe(F.col("of")) & (F.col("part") == F.col("nth")))
    return joined.withColumn("pos", F.col("pos") + F.col("start")).drop("of", "nth", "part", "start")


def _parents(level: Column) -> Column:
    """The next level of a level string: one digest per run of sixteen, the last run may be shorter."""
    runs = F.ceil(F.octet_length(level) / RUN).cast("int")
    hashed = F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(F.substring(level, i * RUN + 1, F.lit(RUN)), 256))
    return F.array_join(hashed, "").cast("binary")


def _own_path(place: Column, levels: list[Column], steps: Column) -> Column:
    """Flanks of a node of a block, level by level up to the block's root."""
    flanks = []
    for i, level in enumerate(levels):
        at = F.floor(place / ARITY**i).cast("int")
        nth = at % ARITY
        flanks.append(F.struct(
            F.substring(level, (at - nth) * DIGITS + 1, nth * DIGITS).alias("left"),
            F.substring(level, (at + 1) * DIGITS + 1, (ARITY - 1 - nth) * DIGITS).alias("right"),
        ))
    return F.slice(F.array(*flanks), F.lit(1), steps)


def _blocks(nodes: DataFrame) -> DataFrame:
    """Blocks of nodes (``g``, ``pos``, ``n``, ``digest`` and more columns): their rows and their levels as strings."""
    rest = [c for c in nodes.columns if c not in ("g", "n", "pos", "digest")]
    grouped = nodes.groupBy("g", "n", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", *rest))).alias("rows")
    )
    n = F.col("n")
    steps = F.when(n <= 1, 0).when(n <= ARITY, 1).when(n <= ARITY**2, 2).otherwise(3)
    out = grouped.withColumn("steps", steps).withColumn("level0", F.array_join(F.transform("rows", lambda r: r["digest"]), "").cast("binary"))
    for i in range(1, LEVELS):
        out = out.withColumn(f"level{i}", F.when(F.col("steps") >= i, _parents(F.col(f"level{i - 1}"))))
    last = F.when(F.col("steps") == LEVELS, _parents(F.col(f"level{LEVELS - 1}")))
    top = F.coalesce(last, *[F.when(F.col("steps") == i, F.col(f"level{i}")) for i in range(LEVELS)])
    return checkpointed(out.withColumn("top", top.cast("string")))


_LEVELS = [f"level{i}" for i in range(LEVELS)]


def _tree(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(paths, roots)``: the flanks from every node (``g``, ``pos``) to its group's root, and ``g``, ``root``."""
    blocks = _blocks(nodes.select("g", "pos", "n", "digest"))
    most = blocks.agg(F.max("n")).first()[0] or 0
    place = lambda r: (r["pos"] % BLOCK).cast("int")
    own = blocks.select("g", "block", F.explode(F.transform("rows", lambda r: F.struct(
        r["pos"].alias("pos"), _own_path(place(r), [F.col(c) for c in _LEVELS], F.col("steps")).alias("path")))).alias("x"))
    own = own.select("g", "block", "x.pos", "x.path")
    if most <= BLOCK:  # every group is one block
        return own.drop("block"), blocks.select("g", F.col("top").alias("root"))
    above = blocks.select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("digest"))
    upper, roots = _tree(above)
    upper = upper.select(F.col("g").alias("u"), F.col("pos").alias("at"), F.col("path").alias("more"))
    joined = own.join(upper, F.col("g").eqNullSafe(F.col("u")) & (F.col("block") == F.col("at")))
    return joined.select("g", "pos", F.concat("path", "more").alias("path")), roots


def build(leaves: DataFrame, group: str = "source", key: str = "doc_id", leaf: str = "leaf", now: str | None = None) -> Manifest:
    """The tree of all leaves: in each group by ``key`` (null first, ties by digest), groups in bytewise order of their
    names (null first).

    Rows with one key are leaves of their own; equal rows too. ``now`` names a digest that is checked in place of the
    stored one (the leaf itself if null or not given). Other columns are not used, whatever their names.
    """
    stored = F.col(leaf)
    given = leaves.select(
        F.col(group).alias("g"), F.col(key).alias("key"), stored.alias("digest"),
        (F.coalesce(F.col(now), stored) if now else stored).alias("now"),
    )
    blocks = _blocks(ranked(given, "g", ["key", "digest", "now"]))
    above = blocks.select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("digest"))
    paths, subroots = _tree(above)
    named = checkpointed(subroots.select(F.lit(0).alias("all"), F.col("g").alias("name"), F.col("root").alias("digest")))
    groups = checkpointed(ranked(named, "all", ["name"]))
    tops, root = _tree(groups.select(F.col("all").alias("g"), "pos", "n", "digest"))
    groups = groups.join(tops.select("pos", F.col("path").alias("more")), "pos").select("name", F.col("digest").alias("subroot"), "more")
    joined = paths.join(groups, F.col("g").eqNullSafe(F.col("name")))
    joined = joined.select("g", F.col("pos").alias("block"), "subroot", F.concat("path", "more").alias("path"))
    return Manifest(blocks, checkpointed(joined), root.select("root"))


def proofs(tree: Manifest) -> DataFrame:
    """One row per leaf: ``group``, ``key``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (hash of all siblings, level by level
    from left to right), ``folded_root`` (the digest in hand folded through the siblings) and ``verified``."""
    paths = tree.paths.select(F.col("g").alias("p_g"), F.col("block").alias("p_block"), "subroot", "path")
    met = tree.blocks.join(paths, F.col("g").eqNullSafe(F.col("p_g")) & (F.col("block") == F.col("p_block")))
    met = met.join(F.broadcast(tree.root))  # one row
    own = F.transform("rows", lambda r: F.struct(
        r["key"].alias("key"), r["digest"].alias("leaf"), r["now"].alias("now"),
        F.concat(_own_path((r["pos"] % BLOCK).cast("int"), [F.col(c) for c in _LEVELS], F.col("steps")), F.col("path")).alias("path"),
    ))
    siblings = lambda p: F.aggregate(p, F.lit(b""), lambda a, s: F.concat(a, s["left"], s["right"]))
    fold = lambda p, d: F.aggregate(p, d, lambda a, s: F.sha2(F.concat(s["left"], a.cast("binary"), s["right"]), 256))
    done = F.transform(own, lambda r: F.struct(
        r["key"].alias("key"), r["leaf"].alias("leaf"),
        F.sha2(siblings(r["path"]), 256).alias("proof_sha256"), fold(r["path"], r["now"]).alias("folded_root"),
    ))
    out = met.select(F.col("g").alias("group"), "subroot", "root", F.explode(done).alias("x"))
    return out.select(
        "group", "x.key", "x.leaf", "subroot", "root", "x.proof_sha256", "x.folded_root", (F.col("x.folded_root") == F.col("root")).alias("verified")
    )
