"""Finding records that describe one artifact, and planning their merges."""

from __future__ import annotations

import difflib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructType

from ledgerfold.functions import text as tx
from ledgerfold.functions.jsonval import get_strings, json_object, let, quote, text_of
from ledgerfold.functions.urls import safe_url, safe_urls
from ledgerfold.operators.graph import (
    alias_index_merge,
    claimed_identifiers,
    related_identifiers,
)
from ledgerfold.operators.ledger import event_frame, with_seq
from ledgerfold.operators.resolve import precedence_of
from ledgerfold.operators.skew import HOT_ROWS, lookup_join, per_key_join
from ledgerfold.session import checkpointed, small_side
from ledgerfold.spec import PROVENANCE_TYPE, UNKNOWN_PRECEDENCE, LedgerSpec

# What a stated relation means for a merge.
SAMENESS = (
    "isidenticalto", "isvariantformof", "isoriginalformof", "issourceof", "isderivedfrom",
    "iscompiledby", "compiles",
)
SUPERSEDED_BY = ("ispreprintof", "ispreviousversionof", "isobsoletedby", "issupersededby")
SUPERSEDES = ("haspreprint", "isnewversionof", "obsoletes")
VERSION_OF = ("isversionof",)
HAS_VERSION = ("hasversion",)
FUZZY_THRESHOLD = 0.90

CANDIDATE = ["primary", "secondary", "kind", "confidence", "evidence", "automatic"]


def primary_rank(resolved: DataFrame, spec: LedgerSpec) -> DataFrame:
    """``(identity_key, rank STRUCT)``: the smaller rank of a pair is the primary."""
    kind = tx.identity_kind(F.col("identity_key"))
    kind_rank = F.when(kind == "doi", 0).when(kind == "source", 1).otherwise(2)
    ranks = F.transform("source_systems", lambda s: precedence_of(s, spec))
    best = F.coalesce(F.array_min(ranks), F.lit(UNKNOWN_PRECEDENCE))
    return resolved.select(
        "identity_key",
        F.struct(
            kind_rank.alias("kind"),
            best.alias("precedence"),
            (-F.size("source_systems")).alias("systems"),
            F.col("identity_key").alias("key"),
        ).alias("rank"),
    )


def star_pairs(claims: DataFrame, key: str, rank: str = "rank", hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(key, primary, secondary)``: the best-ranked holder of a key with each other.

    ``claims`` is ``(key, identity_key, rank)``. A star, never all pairs, so a key
    with n holders gives n-1 rows; a hot key's holders do not move.
    """
    heads = (
        claims.groupBy(key)
        .agg(F.min_by("identity_key", rank).alias("primary"), F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )
    return (
        per_key_join(claims, heads, [key], hot_rows=hot_rows)
        .filter(F.col("identity_key") != F.col("primary"))
        .select(key, "primary", F.col("identity_key").alias("secondary"))
    )


def shared_identifier_pairs(resolved: DataFrame, spec: LedgerSpec) -> DataFrame:
    """Identities asserting one DOI."""
    claims = claimed_identifiers(resolved).join(primary_rank(resolved, spec), "identity_key")
    return star_pairs(claims, "doi").select(
        "primary",
        "secondary",
        F.lit("shared-doi").alias("kind"),
        F.lit(1.0).alias("confidence"),
        F.concat(F.lit("both identities assert DOI "), F.col("doi")).alias("evidence"),
        F.lit(True).alias("automatic"),
    )


def identifier_targets(identifier: Column) -> Column:
    """The identity keys a related identifier may point at."""
    raw = tx.strip(F.coalesce(identifier, F.lit("")))
    bare = F.regexp_replace(raw, r"/+$", "")
    path = F.regexp_extract(bare, r"(?i)^(?:https?://)?github\.com/(.*)$", 1)
    is_repo = bare.rlike(r"(?i)^(?:https?://)?github\.com/")
    repo = F.when(is_repo, F.concat(F.lit("github|"), path))
    return F.array_distinct(
        F.array_compact(
            F.array(
                tx.normalise_doi(raw), repo, F.when(is_repo, F.concat(F.lit("github|"), F.lower(path)))
            )
        )
    )


def relation_candidates(
    statements: DataFrame, index: DataFrame, ranks: DataFrame
) -> DataFrame:
    """Merge candidates from stated relations.

    ``statements`` is ``(identity_key, relation, identifier, target)`` with one row
    per key the identifier may point at; ``index`` maps aliases to identities.
    """
    relation = F.lower(F.translate(F.coalesce("relation", F.lit("")), "-_", ""))
    rows = statements.withColumn("r", relation).filter(
        F.col("r").isin(*SAMENESS, *SUPERSEDED_BY, *SUPERSEDES, *VERSION_OF, *HAS_VERSION)
    )
    rows = lookup_join(
        rows, index.select(F.col("alias").alias("target"), F.col("identity_key").alias("other")), ["target"]
    ).filter(F.col("other") != F.col("identity_key"))
    same = F.col("r").isin(*SAMENESS)
    yields = F.col("r").isin(*SUPERSEDED_BY, *VERSION_OF)
    # Only sameness needs the ranks of both ends; stated directions decide the rest.
    ends = (
        rows.filter(same)
        .join(ranks, "identity_key")
        .join(ranks.select(F.col("identity_key").alias("other"), F.col("rank").alias("other_rank")), "other")
        .withColumn("mine_first", F.col("rank") <= F.col("other_rank"))
        .drop("rank", "other_rank")
    )
    rows = rows.filter(~same).withColumn("mine_first", ~yields).unionByName(ends)
    says = F.concat_ws(" ", F.col("identity_key"), F.lit("declares"), F.coalesce("relation", F.lit("")),
                       F.coalesce("identifier", F.lit("")))
    version = F.col("r").isin(*VERSION_OF, *HAS_VERSION)
    return rows.select(
        F.when(F.col("mine_first"), F.col("identity_key")).otherwise(F.col("other")).alias("primary"),
        F.when(F.col("mine_first"), F.col("other")).otherwise(F.col("identity_key")).alias("secondary"),
        F.when(version, "version-pair").when(same, "related-identifier").otherwise("preprint-pair").alias("kind"),
        F.when(same, 0.95).otherwise(0.99).alias("confidence"),
        F.when(version, F.concat(says, F.lit("; the concept DOI is listed and the version DOI is linked from it")))
        .when(same, says)
        .otherwise(F.concat(says, F.lit("; the published version is listed, the preprint is linked from it")))
        .alias("evidence"),
        F.lit(True).alias("automatic"),
    )


def declared_pairs(resolved: DataFrame, spec: LedgerSpec) -> DataFrame:
    """Candidates from the relations the resolved records state."""
    statements = related_identifiers(resolved).select(
        "identity_key", "relation", "identifier",
        F.explode(identifier_targets(F.col("identifier"))).alias("target"),
    )
    return relation_candidates(statements, alias_index_merge(resolved), primary_rank(resolved, spec))


def one_per_pair(candidates: DataFrame) -> DataFrame:
    """One decision per unordered pair: highest confidence, then kind and names."""
    order = F.struct(
        (-F.col("confidence")).alias("c"), "kind", "primary", "secondary", "evidence"
    )
    return (
        candidates.groupBy(
            F.least("primary", "secondary").alias("_lo"), F.greatest("primary", "secondary").alias("_hi")
        )
        .agg(F.min_by(F.struct(*CANDIDATE), order).alias("c"))
        .select("c.*")
    )


# -- fuzzy titles --------------------------------------------------------------


def title_ratio(left: Column | str, right: Column | str, threshold: float) -> Column:
    """Matching-block similarity of two normalised titles, first argument first.

    Pairs whose character counts alone rule the threshold out get 0 without the
    full comparison, which is quadratic in the length.
    """

    @F.pandas_udf(DoubleType())
    def ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for lefts, rights in batches:
            matcher, out, last = difflib.SequenceMatcher(None), [], None
            for a, b in zip(lefts, rights):
                if b != last:
                    matcher.set_seq2(b)
                    last = b
                matcher.set_seq1(a)
                near = matcher.real_quick_ratio() >= threshold and matcher.quick_ratio() >= threshold
                out.append(matcher.ratio() if near else 0.0)
            yield pd.Series(out, dtype="float64")

    return ratio(left, right)


#: 64-bit words of the bitmaps that tell how far the characters, and the runs of two, of two titles differ at least.
BITMAP_WORDS, PAIR_WORDS = 4, 8
#: One character that is only in one of two texts changes so many of their runs of two at most: two go and one comes.
PAIRS_OF_A_CHARACTER = 3
#: Titles of a group up to which an index by grams is no more work than comparing all of them by bitmaps, and titles of a
#: block of larger groups: each title of a group is sent to every block of it once.
FEW_TITLES, GRID_ROWS = 100, 8_000
#: Titles are compared so many by so many at once, so bitmaps stay in a core's cache.
TILE_ROWS, TILE_COLUMNS = 256, 1024
#: Characters of a title whose places are kept in machine words, 64 in each; longer titles are compared one by one.
WORD_CHARACTERS = 256


def character_bitmap(text: Column, width: int = 1, words: int = BITMAP_WORDS) -> Column:
    """Runs of ``width`` characters of a text with the number of each repeat, hashed to the bits of a few words.

    One character that is only in one of two texts changes one bit at most (``PAIRS_OF_A_CHARACTER`` with runs of two), so
    the bits that differ are a lower bound of the characters that do.
    """
    last = F.length(text) - (width - 1)
    runs = F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, F.lit(width))))
    repeats = lambda c: F.sequence(F.lit(1), ((F.length(text) - F.length(F.replace(text, c, F.lit("")))) / width).cast("int"))
    bits = F.flatten(F.transform(F.array_distinct(F.coalesce(runs, F.array().cast("array<string>"))), lambda c: F.transform(
        repeats(c), lambda i: F.pmod(F.xxhash64(c, i), F.lit(64 * words)).cast("int"))))
    word = lambda all_bits, n: F.aggregate(
        F.filter(all_bits, lambda b: F.floor(b / 64) == n), F.lit(0).cast("bigint"),
        lambda seen, b: seen.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b % 64)))
    return let(bits, lambda all_bits: F.struct(*[word(all_bits, n).alias(f"w{n}") for n in range(words)]))


def _places(text: str) -> dict[str, int]:
    """The places of each character of a text, as bits."""
    out: dict[str, int] = {}
    for i, c in enumerate(text):
        out[c] = out.get(c, 0) | 1 << i
    return out


def _unmatched(places: dict[str, int], size: int, other: str) -> int:
    """Characters outside of a longest common subsequence of two texts; a whole row of its table is one number."""
    row = full = (1 << size) - 1
    for c in other:
        hit = row & places.get(c, 0)
        row = (row + hit) | (row - hit)
    return size + len(other) - 2 * (size - (row & full).bit_count())


def unmatched_characters(left: Column | str, right: Column | str) -> Column:
    """Characters of two texts that no common subsequence matches."""

    @F.pandas_udf(IntegerType())
    def count(lefts: pd.Series, rights: pd.Series) -> pd.Series:
        return pd.Series([_unmatched(_places(a), len(a), b) for a, b in zip(lefts, rights)], dtype="int32")

    return count(left, right)


class _Block:
    """Titles of a block by length, with their bitmaps."""

    def __init__(self, rows: pd.DataFrame):
        self.texts = sorted(rows["title"], key=len)
        self.sizes = np.array([len(t) for t in self.texts], dtype=np.int64)
        order = np.argsort(rows["title"].map(len).to_numpy(), kind="stable")
        bits = np.array(rows["_bits"].tolist(), dtype=np.int64).view(np.uint64)[order]
        self.characters, self.pairs = np.ascontiguousarray(bits[:, :BITMAP_WORDS].T), bits[:, BITMAP_WORDS:]
        self.short = np.array([len(t) <= WORD_CHARACTERS and "\0" not in t for t in self.texts])

    def coded(self, letters: np.ndarray) -> np.ndarray:
        """Each short title as the numbers of its letters, zeros behind it."""
        width = int(max(self.sizes[self.short], default=1))
        short = np.array([t if s else "" for t, s in zip(self.texts, self.short)], dtype=f"U{width}")
        return letters[short.view(np.uint32).reshape(len(short), width)]


def _numbered(left: _Block, right: _Block) -> np.ndarray:
    """By code point the numbers, from 1, of the letters of two blocks."""
    known = sorted({ord(c) for block in (left, right) for c in set("".join(block.texts))} - {0})
    letters = np.zeros(max(known, default=0) + 1, dtype=np.int32)
    letters[known] = np.arange(1, len(known) + 1)
    return letters


def _unmatched_of_short(sizes: np.ndarray, mine: np.ndarray, at: np.ndarray, others: np.ndarray, n_letters: int) -> np.ndarray:
    """:func:`_unmatched` of many pairs at once: of rows ``at`` of ``mine`` with ``others``, both as numbers of letters."""
    longest = int(sizes[at].max())
    words = range(-(-longest // 64))
    places = np.zeros((len(words), len(mine), n_letters + 1), dtype=np.uint64)
    for i in range(longest):
        places[i // 64, np.arange(len(mine)), mine[:, i]] |= np.uint64(1) << np.uint64(i % 64)
    places[:, :, 0] = 0
    unused = [np.clip(64 * (w + 1) - sizes[at], 0, 64) for w in words]
    full = [np.where(n < 64, np.uint64(2**64 - 1) >> (n % 64).astype(np.uint64), np.uint64(0)) for n in unused]
    row = list(full)
    lengths = (others > 0).sum(axis=1)
    for letter in np.ascontiguousarray(others[:, : lengths.max()].T):
        over = np.uint64(0)
        for w in words:
            hit = row[w] & places[w][at, letter]
            total = row[w] + hit
            more = total + over
            over = ((total < hit) | (more < total)).astype(np.uint64)
            row[w] = more | (row[w] - hit)
    matched = sizes[at] - sum(np.bitwise_count(row[w] & full[w]).astype(np.int64) for w in words)
    return sizes[at] + lengths - 2 * matched


def _near_in_blocks(left: _Block, right: _Block, threshold: float) -> Iterator[tuple[str, str]]:
    """Pairs of titles of two blocks, or of one, that may reach the threshold; bitmaps leave most pairs out."""
    most = np.floor(np.arange(left.sizes[-1] + right.sizes[-1] + 1) * (1 - threshold) + 1e-9).astype(np.int64)
    reach = (2 - threshold) / threshold + 1e-9
    letters = _numbered(left, right)
    mine, others = left.coded(letters), right.coded(letters)
    for i in range(0, len(left.texts), TILE_ROWS):
        sizes, met = left.sizes[i : i + TILE_ROWS], []
        first = max(np.searchsorted(right.sizes, sizes[0] / reach), i if left is right else 0)
        last = np.searchsorted(right.sizes, sizes[-1] * reach, "right")
        for j in range(first, last, TILE_COLUMNS):
            to = min(j + TILE_COLUMNS, last)
            differ = np.zeros((len(sizes), to - j), dtype=np.uint8)  # 256 would wrap to 0, and the pair only stays longer
            for a, b in zip(left.characters, right.characters, strict=True):
                differ += np.bitwise_count(a[i : i + TILE_ROWS, None] ^ b[None, j:to])
            found = np.flatnonzero(differ <= np.minimum(most[sizes[-1] + right.sizes[j:to]], 255).astype(np.uint8))
            at, on = np.divmod(found, to - j)
            far = differ[at, on]
            on += j
            allowed = most[sizes[at] + right.sizes[on]]
            stays = far <= allowed
            if left is right:
                stays &= at + i < on
            at, on, allowed = at[stays], on[stays], allowed[stays]
            pairs = np.bitwise_count(left.pairs[at + i] ^ right.pairs[on]).sum(axis=1, dtype=np.int64)
            stays = pairs <= PAIRS_OF_A_CHARACTER * allowed
            met.append((at[stays], on[stays], allowed[stays]))
        if not met:
            continue
        at, on, allowed = (np.concatenate(x) for x in zip(*met))
        short = left.short[at + i] & right.short[on]
        x, y = at[short], on[short]
        if len(x):
            near = _unmatched_of_short(sizes, mine[i : i + TILE_ROWS], x, others[y], int(letters.max())) <= allowed[short]
            yield from ((left.texts[a + i], right.texts[b]) for a, b in zip(x[near].tolist(), y[near].tolist()))
        for a, b, n in zip(at[~short].tolist(), on[~short].tolist(), allowed[~short].tolist()):
            text, other = left.texts[a + i], right.texts[b]
            if _unmatched(_places(text), len(text), other) <= n:
                yield text, other


def _near_in_grid(titles: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Similar titles of large groups: a group's titles are dealt to ``_blocks`` blocks, and every two blocks meet once, in a
    cell of their own. A task holds two blocks, and hands on what is near."""
    tasks = int(titles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = [character_bitmap(F.col("title")).alias("_c"), character_bitmap(F.col("title"), 2, PAIR_WORDS).alias("_p")]
    # titles and cells are few bytes and much work, so their tasks are not merged by size
    coded = titles.repartition(tasks, *keys, "title").select(*keys, "title", "_blocks", F.pmod(F.xxhash64("title"), F.col("_blocks")).cast("int").alias("_block"), *words)
    bits = F.array(*[f"_c.w{n}" for n in range(BITMAP_WORDS)], *[f"_p.w{n}" for n in range(PAIR_WORDS)])
    coded = checkpointed(coded.withColumn("_bits", bits).drop("_c", "_p"))
    sent = coded.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    cell = [F.least("_block", "_other").alias("_low"), F.greatest("_block", "_other").alias("_high")]
    cells = sent.select(*keys, *cell, "_block", "title", "_bits").repartition(tasks, *keys, "_low", "_high")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        low = rows["_block"] == rows["_low"]
        left = _Block(rows[low]) if low.any() else None
        right = left if rows["_low"].iloc[0] == rows["_high"].iloc[0] else _Block(rows[~low]) if not low.all() else None
        found = list(_near_in_blocks(left, right, threshold)) if left and right else []
        named = {k: [rows[k].iloc[0]] * len(found) for k in keys}
        return pd.DataFrame({**named, "_a": [a for a, _ in found], "_b": [b for _, b in found]}, dtype=None if found else object)

    schema = StructType([*titles.select(*keys).schema.fields]).add("_a", StringType()).add("_b", StringType())
    near = cells.groupBy(*keys, "_low", "_high").applyInPandas(compare, schema)
    return near.select(*keys, F.least("_a", "_b").alias("left_title"), F.greatest("_a", "_b").alias("right_title"))


def similar_titles(
    titles: DataFrame, keys: list[str], threshold: float = FUZZY_THRESHOLD, hot_rows: int = HOT_ROWS,
    block_rows: int = GRID_ROWS, few_rows: int = FEW_TITLES,
) -> DataFrame:
    """Pairs of different titles inside a block that may reach the threshold.

    ``titles`` is distinct ``(keys..., title)``. The ratio is twice the matched characters over the total, and the
    matched characters are a common subsequence, so similar titles differ by few insertions and deletions: those
    that leave no more characters unmatched than the threshold allows are returned, and the exact ratio decides afterwards.

    Of a block of few titles all pairs are never formed: similar titles must share many q-grams. Each title is indexed
    under just enough of its rarest grams that two titles sharing as many as the
    threshold demands meet in at least one. The index never misses a pair (see the
    brute-force test). In a block of more than ``few_rows`` titles grams are frequent, most so where few words make all titles,
    and a pair would meet in many of them. There each pair is compared once, by bitmaps, in a grid whose cells hold about twice
    ``block_rows`` titles at most.
    """
    q = 3 if threshold >= 0.88 else 1
    width = F.length("title")
    sized = titles.select(*keys, "title").filter(width >= q)
    for key in keys:
        sized = sized.filter(F.col(key).isNotNull())
    large = checkpointed(
        sized.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > few_rows)
        .select(*keys, F.ceil(F.col("_rows") / block_rows).cast("int").alias("_blocks"))
    )
    if large.isEmpty():
        return _near_by_grams(sized, keys, threshold, q, hot_rows)
    few = _near_by_grams(sized.join(small_side(large), keys, "left_anti"), keys, threshold, q, hot_rows)
    return few.unionByName(_near_in_grid(sized.join(small_side(large), keys), keys, threshold))


def _near_by_grams(sized: DataFrame, keys: list[str], threshold: float, q: int, hot_rows: int) -> DataFrame:
    """Similar titles that meet in one of their rarest q-grams."""
    width = F.length("title")
    total = width + F.ceil(width * threshold / (2 - threshold))
    need = total * 0.5 - (q - 1) - (2 * q - 1) / 2 * (1 - threshold) * total
    need = F.greatest(F.ceil(need - 1e-9), F.lit(1)).cast("int")
    # Titles this much apart in length are at most one class apart.
    step = math.log((2 - threshold) / threshold) + 1e-9
    length_class = F.floor(F.log(width) / step).cast("int")
    plain = sized.select(
        *keys,
        "title",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), width - (q - 1)),
                lambda i: F.substring(F.col("title"), i, F.lit(q)),
            )
        ).alias("g"),
    )
    # Repeats are numbered, which turns the grams of a title into a set.
    grams = (
        plain.groupBy(*keys, "title", "g")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*keys, "title", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("i"), "g")
        .select(*keys, "title", F.concat("g", F.lit("#"), F.col("i").cast("string")).alias("gram"))
    )
    counts = grams.groupBy(*keys, "gram").agg(F.count(F.lit(1)).alias("rows"))
    weighed = per_key_join(
        grams, counts.withColumn("seen", F.col("rows")), [*keys, "gram"], hot_rows=hot_rows
    )
    place = F.row_number().over(W.partitionBy(*keys, "title").orderBy("seen", "gram"))
    prefix = F.greatest(width - (q - 1) - need + 1, F.lit(1))
    indexed = checkpointed(
        weighed.withColumn("_place", place)
        .filter((F.col("_place") <= prefix) & (F.col("seen") > 1))
        .select(*keys, "gram", "title", length_class.alias("size_class"), character_bitmap(F.col("title")).alias("bits"))
    )
    near = F.explode(F.transform(F.array(*[F.lit(d) for d in (-1, 0, 1)]), lambda d: F.col("size_class") + d))
    named = lambda n: [F.col("title").alias(f"{n}_title"), F.col("bits").alias(f"{n}_bits")]
    left = indexed.select(*keys, "gram", "size_class", *named("left"))
    right = indexed.select(*keys, "gram", *named("right"), near.alias("size_class"))
    la, lb = F.length("left_title"), F.length("right_title")
    unmatched = F.floor((la + lb) * (1 - threshold) + 1e-9).cast("int")
    differ = sum(F.bit_count(F.col(f"left_bits.w{n}").bitwiseXOR(F.col(f"right_bits.w{n}"))) for n in range(BITMAP_WORDS))
    met = (
        left.join(right, [*keys, "gram", "size_class"])
        .filter((F.col("left_title") < F.col("right_title"))
                & (F.least(la, lb) * 2.0 / (la + lb) >= threshold)
                & (differ <= unmatched)
                & (F.call_function("levenshtein", "left_title", "right_title", unmatched) >= 0))
        .select(*keys, "left_title", "right_title")
        .distinct()
    )
    return met.filter(unmatched_characters("left_title", "right_title") <= unmatched)


def title_members(records: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, title, head, member, rank)``: every record under the best-ranked record of its title.

    This expands a link between titles to all records behind it. ``records`` is ``(identity_key, keys,
    title)`` and, where there is one, ``rank``; the smallest rank heads a title, otherwise the smallest key.
    """
    rows = records.filter(F.col("title") != "")
    if "rank" not in records.columns:
        rows = rows.withColumn("rank", F.col("identity_key"))
    rows = checkpointed(rows.select(*keys, "title", "rank", "identity_key"))  # what titles are taken from is read once
    heads = rows.groupBy(*keys, "title").agg(
        F.min(F.struct("rank", "identity_key"))["identity_key"].alias("head"), F.count(F.lit(1)).alias("rows")
    )
    found = per_key_join(rows, heads, [*keys, "title"])
    return found.select(*keys, "title", "head", F.col("identity_key").alias("member"), "rank")


def near_titles(titles: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """``(keys, left_title, right_title, confidence)`` of different titles that are near enough. The ratio
    depends on the order of its arguments; the larger one counts."""
    ratio = F.greatest(
        title_ratio("left_title", "right_title", threshold), title_ratio("right_title", "left_title", threshold)
    )
    met = similar_titles(titles, keys, threshold)
    return met.select(*keys, "left_title", "right_title", ratio.alias("confidence")).filter(F.col("confidence") >= threshold)


def _star(members: DataFrame, keys: list[str]) -> DataFrame:
    """Each record of a title linked with the title's head; ``link`` tells one link from another."""
    return members.filter(F.col("member") != F.col("head")).select(
        *keys, F.col("title").alias("left_title"), F.col("title").alias("right_title"), F.col("member").alias("link"),
        F.least("head", "member").alias("left"), F.greatest("head", "member").alias("right"), F.lit(1.0).alias("confidence"),
    )


def _across(near: DataFrame, left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Records of two near titles, those of ``left`` with those of ``right``."""
    side = lambda rows, n: rows.select(*keys, F.col("title").alias(f"{n}_title"), F.col("identity_key").alias(f"_{n}"))
    linked = near.join(side(left, "left"), [*keys, "left_title"]).join(side(right, "right"), [*keys, "right_title"])
    return linked.select(
        *keys, "left_title", "right_title", F.lit(None).cast(linked.schema["_left"].dataType).alias("link"),
        F.least("_left", "_right").alias("left"), F.greatest("_left", "_right").alias("right"), "confidence",
    )


def fuzzy_pairs(records: DataFrame, keys: list[str], threshold: float = FUZZY_THRESHOLD) -> DataFrame:
    """Fuzzy links ``(keys, left, right, confidence)`` over ``(identity_key, keys, title)``.

    One rule at every size: a title's records are a star around its best-ranked record, and two near titles
    are linked once, between those records. What is alike stays proposed and connected, and rows grow
    with records and near titles, never with the square of a title's records; see ``title_members``.
    """
    members = checkpointed(title_members(records, keys))
    heads = members.filter(F.col("member") == F.col("head")).select(*keys, "title", F.col("head").alias("identity_key")).distinct()
    heads = checkpointed(heads)
    near = near_titles(heads.select(*keys, "title"), keys, threshold)
    return _star(members, keys).unionByName(_across(near, heads, heads, keys)).select(*keys, "left", "right", "confidence")


def possible_links(records: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """The links of :func:`fuzzy_pairs` with what may stand in for them: between two near titles, the head of
    either with any record of the other. ``(keys, left_title, right_title, link)`` names one link."""
    members = checkpointed(title_members(records, keys))
    rows = members.select(*keys, "title", F.col("member").alias("identity_key"))
    heads = members.filter(F.col("member") == F.col("head")).select(*keys, "title", F.col("head").alias("identity_key")).distinct()
    near = checkpointed(near_titles(heads.select(*keys, "title"), keys, threshold))
    either = _across(near, heads, rows, keys).unionByName(_across(near, rows, heads, keys)).distinct()
    return _star(members, keys).unionByName(either)


def first_author(effective: Column) -> Column:
    """Normalised surname of the first author with a name; empty when there is none."""
    authors = F.try_variant_get(
        F.try_parse_json(F.element_at(effective, "authors")), "$", "array<variant>"
    )
    name = lambda a: F.coalesce(
        tx.blank_to_null(F.try_variant_get(a, "$.name", "string")),
        tx.blank_to_null(F.try_variant_get(a, "$.family", "string")),
        F.when(~F.to_json(a).startswith("{"), F.try_variant_get(a, "$", "string")),
    )
    names = F.filter(F.transform(authors, name), lambda n: n.isNotNull() & (n != ""))
    return F.coalesce(tx.normalise_author(F.get(names, F.lit(0))), F.lit(""))


def fuzzy_candidates(
    resolved: DataFrame, decided: DataFrame, spec: LedgerSpec, threshold: float = FUZZY_THRESHOLD
) -> DataFrame:
    """Review-only candidates: like titles with one first author and year.

    Pairs already decided and pairs sharing a DOI are not guesses and are left out; the best-ranked of the
    pairs that remain between two titles is proposed. If none remains, the titles are already connected.
    """
    ranks = primary_rank(resolved, spec)
    published = F.coalesce(text_of(F.element_at("effective", "published_date")), F.lit(""))
    blocks = resolved.select(
        "identity_key",
        first_author(F.col("effective")).alias("author"),
        tx.year_of(published).alias("year"),
        tx.normalise_title(F.coalesce(text_of(F.element_at("effective", "title")), F.lit(""))).alias("title"),
    ).filter((F.col("author") != "") & (F.col("year") != "")).join(ranks, "identity_key")
    links = checkpointed(possible_links(blocks, ["author", "year"], threshold))
    known = decided.select(
        F.least("primary", "secondary").alias("left"), F.greatest("primary", "secondary").alias("right")
    )
    links = links.join(known, ["left", "right"], "left_anti")
    dois = claimed_identifiers(resolved)
    shared = (
        links.select("left", "right")
        .join(dois.withColumnsRenamed({"identity_key": "left"}), "left")
        .join(dois.withColumnsRenamed({"identity_key": "right"}), ["right", "doi"])
        .select("left", "right")
    )
    links = links.join(shared, ["left", "right"], "left_anti")
    every = links.join(
        ranks.withColumnsRenamed({"identity_key": "left", "rank": "lr"}), "left"
    ).join(ranks.withColumnsRenamed({"identity_key": "right", "rank": "rr"}), "right")
    best = F.min(F.struct(F.least("lr", "rr").alias("first"), F.greatest("lr", "rr").alias("second"), "left", "right", "lr", "rr", "confidence"))
    ranked = every.groupBy("author", "year", "left_title", "right_title", "link").agg(best.alias("b")).select("author", "year", "b.*")
    left_first = F.col("lr") <= F.col("rr")
    return ranked.select(
        F.when(left_first, F.col("left")).otherwise(F.col("right")).alias("primary"),
        F.when(left_first, F.col("right")).otherwise(F.col("left")).alias("secondary"),
        F.lit("fuzzy-title").alias("kind"),
        "confidence",
        F.concat(
            F.lit("title similarity "), F.format_number("confidence", 2),
            F.lit(" with the same first author ("), F.col("author"), F.lit(") and year ("),
            F.col("year"), F.lit("); no shared DOI — REVIEW REQUIRED"),
        ).alias("evidence"),
        F.lit(False).alias("automatic"),
    )


def find_candidates(
    resolved: DataFrame, spec: LedgerSpec | None = None, threshold: float = FUZZY_THRESHOLD
) -> DataFrame:
    """Every candidate, one per pair; ``(not automatic, kind, primary, secondary)`` orders them."""
    spec = spec or LedgerSpec()
    automatic = one_per_pair(
        shared_identifier_pairs(resolved, spec).unionByName(declared_pairs(resolved, spec))
    )
    return automatic.unionByName(fuzzy_candidates(resolved, automatic, spec, threshold))


def connected_components(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, component)`` with the smallest node of each component.

    Alternates two steps until nothing moves: every node's larger neighbours are
    hung under its smallest neighbour, then the smaller ones too. Rounds grow with
    the logarithm of the size. A step is one aggregate with a map-side minimum and one join, whose large
    partitions AQE splits. Lineage is cut every round, so a lost executor repeats one round only.
    """
    edges = checkpointed(
        pairs.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b")).filter("a <> b").distinct()
    )
    nodes = edges.select("a").union(edges.select("b")).distinct()

    def under_smallest(links: DataFrame) -> DataFrame:
        """``links`` with ``m``: the smallest of ``a`` and its neighbours ``b``."""
        smallest = links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return links.join(smallest, "a")

    seen = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        larger = under_smallest(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        smaller = under_smallest(larger)
        edges = checkpointed(
            smaller.select("a", F.col("m").alias("b"))
            .union(smaller.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
            .distinct()
        )
        # row count and the sum of row hashes tell whether a round changed anything
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return nodes.join(edges, "a", "left").select(F.col("a").alias("node"), F.coalesce("b", "a").alias("component"))


# -- merges --------------------------------------------------------------------


def order_candidates(candidates: DataFrame) -> DataFrame:
    """Candidates with ``place``, the struct every merge is replayed by."""
    return candidates.withColumn("place", F.struct("kind", "primary", "secondary"))


def already_merged(candidates: DataFrame, resolved: DataFrame) -> DataFrame:
    """Candidates whose secondary is suppressed into that very primary."""
    local = F.col("local")
    state = resolved.filter(F.element_at(local, "suppressed") == "true").select(
        F.col("identity_key").alias("secondary"),
        text_of(F.element_at(local, "merged_into")).alias("primary"),
    )
    return candidates.join(state, ["primary", "secondary"], "left_semi")


def plan_merges(candidates: DataFrame, merged: DataFrame) -> DataFrame:
    """The automatic candidates to apply, in replay order by ``place``.

    A merge already standing is skipped while nothing earlier in the plan gives its
    secondary another primary; ``merged`` lists the standing ones.
    """
    automatic = order_candidates(candidates.filter("automatic"))
    standing = merged.select("primary", "secondary", F.lit(True).alias("standing"))
    rows = automatic.join(standing, ["primary", "secondary"], "left")
    first = rows.groupBy("secondary").agg(
        F.min("place").alias("first_place"), F.count(F.lit(1)).alias("rows")
    )
    placed = per_key_join(rows, first, ["secondary"])
    skip = F.coalesce("standing", F.lit(False)) & (F.col("place") == F.col("first_place"))
    return placed.filter(~skip).drop("standing", "first_place")


def record_urls(resolved: DataFrame) -> DataFrame:
    """``(identity_key, url, at)``: safe URLs a record hands over, landing page first."""
    listed = safe_urls(
        get_strings(F.try_parse_json(F.element_at("effective", "source_urls")), "$")
    )
    own = safe_url(text_of(F.element_at("effective", "url")))
    urls = F.when(own.isNotNull() & ~F.array_contains(listed, own), F.concat(F.array(own), listed)).otherwise(listed)
    return resolved.select("identity_key", F.posexplode(urls).alias("at", "url"))


def merge_urls(plan: DataFrame, urls: DataFrame) -> DataFrame:
    """``(place, primary, secondary, url)``: what each merge copies to its primary.

    Merges replay in order, so a URL travels along a chain only when the later hop
    comes later. A jump is a path of 1, 2, 4, ... hops that come one after another, with the place of its first hop and of
    its last. URLs take the jumps of one length after the other, keeping the earliest arrival, which covers
    chains of every length: one of n hops takes log2(n) rounds. Between two records only jumps stay that no
    other one starts after and arrives before.
    """
    hops = plan.select("place", "primary", "secondary")
    start = F.struct(*[F.lit("").alias(n) for n in ("kind", "primary", "secondary")])
    known = checkpointed(urls.select("identity_key", "url").distinct().withColumn("since", start))
    jumps = checkpointed(best_jumps(hops.select(
        F.col("secondary").alias("from"), F.col("primary").alias("to"), F.col("place").alias("starts"), F.col("place").alias("arrives"))))
    while not jumps.isEmpty():
        moved = (
            known.join(jumps.withColumnRenamed("from", "identity_key"), "identity_key")
            .filter(F.col("starts") > F.col("since"))
            .select(F.col("to").alias("identity_key"), "url", F.col("arrives").alias("since"))
        )
        known = checkpointed(known.unionByName(moved).groupBy("identity_key", "url").agg(F.min("since").alias("since")))
        then = jumps.select(F.col("from").alias("to"), F.col("to").alias("on"), F.col("starts").alias("next"), F.col("arrives").alias("ends"))
        longer = jumps.join(then, "to").filter(F.col("arrives") < F.col("next"))
        jumps = checkpointed(best_jumps(longer.select("from", F.col("on").alias("to"), "starts", F.col("ends").alias("arrives"))))
    return (
        hops.join(known.withColumnRenamed("identity_key", "secondary"), "secondary")
        .filter(F.col("since") < F.col("place"))
        .select("place", "primary", "secondary", "url", "since")
    )


def best_jumps(jumps: DataFrame) -> DataFrame:
    """Of the jumps between two records those that no other one starts with or after and arrives before."""
    later = W.partitionBy("from", "to").orderBy(F.desc("starts"), "arrives").rowsBetween(W.unboundedPreceding, -1)
    soonest = jumps.withColumn("_soonest", F.min("arrives").over(later))
    return soonest.filter(F.col("_soonest").isNull() | (F.col("arrives") < F.col("_soonest"))).drop("_soonest")


def link_url(resolved: DataFrame) -> DataFrame:
    """``(identity_key, link)``: the page a merge links to, NULL when there is none."""
    listed = safe_urls(get_strings(F.try_parse_json(F.element_at("effective", "source_urls")), "$"))
    return resolved.select(
        "identity_key",
        F.coalesce(safe_url(text_of(F.element_at("effective", "url"))), F.get(listed, F.lit(0))).alias("link"),
    )


def merge_events(
    plan: DataFrame, urls: DataFrame, links: DataFrame, observed_at: Column, first_seq: int = 0
) -> DataFrame:
    """Two annotations per merge: the primary gains the secondary's ways in, the
    secondary is suppressed and points back. Nothing is deleted.

    ``merged_from`` is written as the one name each merge adds and unions in the
    fold, so absorbing n records costs n names and not n squared.
    """
    carried = (
        merge_urls(plan, urls)
        .join(urls.withColumnRenamed("identity_key", "secondary"), ["secondary", "url"], "left")
        .groupBy("place")
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("since", "at", "url"))), lambda u: u["url"]
            ).alias("urls")
        )
    )
    side = lambda n: links.select(F.col("identity_key").alias(n), F.col("link").alias(f"{n}_link"))
    rows = (
        plan.join(carried, "place", "left")
        .join(side("primary"), "primary", "left")
        .join(side("secondary"), "secondary", "left")
    )

    def link(url: Column, label: Column) -> Column:
        entry = json_object([("url", quote(url)), ("label", quote(label))])
        return F.when(url.isNotNull(), F.concat(F.lit("["), entry, F.lit("]"))).otherwise("[]")

    none = F.array().cast("array<string>")
    gains = json_object(
        [
            ("source_urls", F.to_json(F.coalesce("urls", none))),
            ("links", link(F.col("secondary_link"), F.concat(F.lit("Also catalogued as "), F.col("secondary")))),
            ("merged_from", F.to_json(F.array("secondary"))),
        ]
    )
    yields = json_object(
        [
            ("suppressed", F.lit("true")),
            ("merged_into", quote(F.col("primary"))),
            ("links", link(F.col("primary_link"), F.concat(F.lit("Catalogued as "), F.col("primary")))),
        ]
    )
    what = F.concat(F.lit("merge ("), F.col("kind"), F.lit("): "))
    pair = F.array(
        F.struct(
            F.col("primary").alias("identity_key"), gains.alias("local"),
            F.concat(what, F.lit("absorbed "), F.col("secondary"), F.lit(" — "), F.col("evidence")).alias("note"),
        ),
        F.struct(
            F.col("secondary").alias("identity_key"), yields.alias("local"),
            F.concat(what, F.lit("superseded by "), F.col("primary"),
                     F.lit(" — retained and citable, removed from listings")).alias("note"),
        ),
    )
    both = rows.select("place", F.posexplode(pair).alias("side", "e")).select("place", "side", "e.*")
    return event_frame(
        with_seq(both, ["place", "side"], first_seq)
        .withColumn("event_type", F.lit("annotated"))
        .withColumn("actor", F.lit("reconcile"))
        .withColumn("observed_at", observed_at)
    )


def merge_proposals(candidates: DataFrame) -> DataFrame:
    """Fuzzy candidates as ``merge_proposal`` notices on their primary."""
    notice = json_object(
        [
            ("kind", quote(F.col("kind"))),
            ("evidence", quote(F.col("evidence"))),
            ("confidence", F.col("confidence").cast("string")),
            ("other", quote(F.col("secondary"))),
            ("action", quote(F.lit("review required — no merge was applied"))),
        ]
    )
    return candidates.filter(~F.col("automatic")).select(
        F.col("primary").alias("identity_key"),
        F.lit("merge_proposal").alias("event_type"),
        notice.alias("notice"),
        F.concat(F.col("kind"), F.lit(": "), F.col("evidence")).alias("note"),
    )


def new_notices(proposed: DataFrame, events: DataFrame) -> DataFrame:
    """Notices no event of the identity states already, compared as canonical JSON."""
    standing = events.filter(F.col("notice").isNotNull()).select("identity_key", "event_type", "notice")
    return proposed.join(standing.distinct(), ["identity_key", "event_type", "notice"], "left_anti")


# -- promotion of candidate tasks ----------------------------------------------


def canonical_group(name: Column, groups: DataFrame, rows: DataFrame, out: str) -> DataFrame:
    """Add column ``out``: the registered name of ``name``, by name or alias, else itself.

    ``groups`` is ``(name, aliases)``; a name beats an alias.
    """
    place = F.col("pos") if "pos" in groups.columns else F.lit(0)
    names = groups.select(
        F.col("name").alias("_k"), F.col("name").alias("_n"), F.struct(F.lit(1), place).alias("_p")
    )
    aliases = groups.select(
        F.explode("aliases").alias("_k"), F.col("name").alias("_n"), F.struct(F.lit(0), place).alias("_p")
    )
    # A name beats an alias; of two groups with one alias the later registered wins.
    lookup = names.unionByName(aliases).groupBy("_k").agg(F.max_by("_n", "_p").alias("_canon"))
    key = F.lower(tx.strip(name))
    return (
        rows.withColumn("_k", key)
        .join(lookup, "_k", "left")
        .withColumn(out, F.coalesce("_canon", "_k"))
        .drop("_k", "_canon")
    )


def promotions(candidates: DataFrame, held: DataFrame, groups: DataFrame) -> DataFrame:
    """``(identity_key, pos, task)``: candidate tasks that are registered and not held.

    ``candidates`` is ``(identity_key, pos, value)`` and ``held`` ``(identity_key, value)``.
    """
    proposed = canonical_group(tx.normalise_task(F.col("value")), groups, candidates, "task")
    has = canonical_group(F.col("value"), groups, held, "task").select("identity_key", "task")
    return (
        proposed.join(groups.select(F.col("name").alias("task")), "task", "left_semi")
        .join(has, ["identity_key", "task"], "left_anti")
        .groupBy("identity_key", "task")
        .agg(F.min("pos").alias("pos"))
    )


def promote_task_candidates(
    resolved: DataFrame, groups: DataFrame, spec: LedgerSpec, observed_at: Column
) -> DataFrame:
    """``annotated`` events for the promotions of resolved records."""
    extra = F.try_parse_json(F.element_at("effective", "extra"))
    cands = resolved.select(
        "identity_key",
        F.posexplode(get_strings(extra, f"$.{spec.task_field}_candidates")).alias("pos", "value"),
    )
    held = resolved.select(
        "identity_key",
        F.explode(get_strings(F.try_parse_json(F.element_at("effective", spec.task_field)), "$")).alias("value"),
    )
    found = promotions(cands, held, groups).groupBy("identity_key").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "task"))), lambda p: p["task"]).alias("tasks")
    )
    entry = F.from_json(
        F.lit('{"%s":{"extraction_method":"pattern"}}' % spec.task_field), PROVENANCE_TYPE
    )
    return event_frame(
        found.select(
            "identity_key",
            F.lit("annotated").alias("event_type"),
            F.concat(F.lit('{"%s":' % spec.task_field), F.to_json("tasks"), F.lit("}")).alias("local"),
            entry.alias("provenance"),
            F.lit("reconcile").alias("actor"),
            F.lit("task candidate promoted from source metadata and validated against the register").alias("note"),
            observed_at.alias("observed_at"),
        )
    )
