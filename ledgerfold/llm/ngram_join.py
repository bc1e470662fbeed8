"""Documents linked by the Jaccard similarity of their word n-grams, found by a prefix-tree join.

1. Every text becomes a set of 64-bit shingle hashes. A global order puts rare shingles first; it comes from
   an exact count of all shingles by hash bucket, a table of fixed size.
2. Linked sets share a shingle among the first ones of each (as many as a link may miss, and one). Sets that
   share one and whose bitmaps don't rule a link out are candidates; candidates form clusters.
3. In a cluster the sets are stored in a prefix tree in one order. A walk down the tree carries the overlaps of
   all query sets with the path, so sets with a common beginning share them, and leaves a subtree once
   the lengths that remain can't give a link. Overlaps at the leaves are exact.

Equal sets are one set from the start. Large clusters are joined in blocks, all blocks with all, and tasks
hand on a spanning forest of the links, never all pairs. Sets and shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import checkpointed
from ledgerfold.llm.components import components
from ledgerfold.session import small_side

WORDS, PERCENT = 4, 85
#: Buckets of the count that orders shingles, and of one row of it.
BUCKET_BITS, SLICE_BITS = 20, 12
#: Sets of a block of a cluster or of a group, and cells of the membership table in a task.
BLOCK, CELLS = 2048, 1 << 23
#: Groups of so many sets or fewer are tested together with others of their size.
FEW = 24
#: Rows of groups that go to a call together, about.
CALL_ROWS = 50_000
#: Partitions whose counts are added up together, before their sums are.
PARTITIONS = 64
#: Texts whose shingles a worker holds at once.
TOGETHER = 500
#: Bits of the smallest bitmap. A set has a bitmap of at least as many bits as shingles.
LEAST_BITS = 512
#: Remembered word hashes of a worker.
KEPT_WORDS = 150_000
#: Fixed value: an odd 64-bit multiplier, the golden ratio's.
MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_hashes = WordHashes()


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of so many words; of all words where there are fewer. Words are
    what ASCII white space leaves, A-Z in lower case."""
    found = (text or "").encode().lower().split()
    h = np.fromiter(map(_hashes.__getitem__, found), dtype=np.uint64, count=len(found))
    if not len(h):
        return h
    runs = max(1, len(h) - words + 1)
    z = np.full(runs, min(len(h), words), dtype=np.uint64)
    for i in range(min(len(h), words)):
        z = (z ^ h[i : i + runs]) * MIX
        z ^= z >> np.uint64(29)
    return np.unique(z)


def least_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The least intersection of sets of these sizes that makes a link."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    """Of sets that link, the first so many shingles of each hold a common one."""
    return n - (-(-percent * n // 100)) + 1


def bitmap(s: np.ndarray) -> bytes:
    """Parity of the shingles by hashed bit. Two bitmaps differ in no more bits than their sets in members;
    one of twice the bits folds into a smaller one."""
    bits = LEAST_BITS
    while bits < len(s):
        bits *= 2
    at = ((s * MIX) >> np.uint64(20)) & np.uint64(bits - 1)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def may_link(maps: list[bytes], sizes: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places whose sizes and bitmaps allow a link; sorted by size, so partners are near each other."""
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    unfolded = [np.frombuffer(maps[i], dtype=np.uint64) for i in order]
    width = min(len(m) for m in unfolded)
    folded: dict[int, np.ndarray] = {}

    def at_width(w: int) -> np.ndarray:
        if w not in folded:
            rows = [m.reshape(-1, w) if len(m) >= w else None for m in unfolded]
            folded[w] = np.stack([np.bitwise_xor.reduce(r, axis=0) if r is not None else np.zeros(w, np.uint64) for r in rows])
        return folded[w]

    for i in range(len(sizes)):
        last = np.searchsorted(sizes, 100 * sizes[i] // percent, side="right")
        if last <= i + 1:
            continue
        w = max(width, len(unfolded[i]))  # partners are as long or longer, so their bitmaps fold to this
        m = at_width(w)
        apart = np.bitwise_count(m[i + 1 : last] ^ m[i]).sum(axis=1, dtype=np.int64)
        both = sizes[i] + sizes[i + 1 : last]
        ok = np.flatnonzero(apart <= both - 2 * least_overlap(both, 0, percent)) + i + 1
        if len(ok):
            yield np.full(len(ok), order[i]), order[ok]


class Bitmaps:
    """Bitmaps of many sets by width, for testing many pairs at once."""

    def __init__(self, maps: list[bytes], sizes: np.ndarray, percent: int):
        self.sizes, self.percent = sizes, percent
        self.width = np.array([len(m) // 8 for m in maps], dtype=np.int64)
        self.rows, self.tables = np.empty(len(maps), dtype=np.int64), {}
        for w in np.unique(self.width):
            mine = np.flatnonzero(self.width == w)
            self.rows[mine] = np.arange(len(mine))
            self.tables[int(w)] = np.frombuffer(b"".join([maps[i] for i in mine]), dtype=np.uint64).reshape(len(mine), w)

    def folded(self, places: np.ndarray, width: int) -> np.ndarray:
        table = self.tables[int(self.width[places[0]])][self.rows[places]]
        return np.bitwise_xor.reduce(table.reshape(len(places), -1, width), axis=1)

    def allow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of these pairs may link."""
        both = self.sizes[a] + self.sizes[b]
        ok = 100 * np.minimum(self.sizes[a], self.sizes[b]) >= self.percent * np.maximum(self.sizes[a], self.sizes[b])
        most = both - 2 * least_overlap(both, 0, self.percent)
        widths = self.width[a] * (1 << 32) + self.width[b]
        for w in np.unique(widths[ok]):
            for at in np.array_split(mine := np.flatnonzero(ok & (widths == w)), 1 + len(mine) // 65_536):
                if len(at):
                    narrow = int(min(self.width[a[at[0]]], self.width[b[at[0]]]))
                    differ = self.folded(a[at], narrow) ^ self.folded(b[at], narrow)
                    ok[at] = np.bitwise_count(differ).sum(axis=1, dtype=np.int64) <= most[at]
        return ok


class Forest:
    """Union-find over places; remembers the links that joined two trees."""

    def __init__(self, n: int):
        self.parent, self.links = list(range(n)), []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def add(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.parent[y] = x
            self.links.append((a, b))


def tree_join(sets: list[np.ndarray], queries: list[np.ndarray], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of ``(query, set)`` with 100 * intersection >= percent * union, by one walk of the prefix tree of
    ``sets`` for each batch of queries. The tree is the sorted list of sets, frequent shingles first;
    a node is a range of the list with a common beginning."""
    tokens, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(tokens), dtype=np.int64)
    rank[np.lexsort((tokens, -count))] = np.arange(len(tokens))
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    paths = [np.sort(p) for p in np.split(rank[inverse], cuts)]
    order = sorted(range(len(sets)), key=lambda i: paths[i].astype(">i8").tobytes())
    paths = [paths[i] for i in order]
    lengths = np.array([len(p) for p in paths])
    order = np.array(order)
    batch = max(1, CELLS // max(1, len(tokens)))
    for start in range(0, len(queries), batch):
        mine = queries[start : start + batch]
        member = np.zeros((len(tokens), len(mine)), dtype=np.uint8)
        for q, s in enumerate(mine):
            at = np.searchsorted(tokens, s)
            at[at == len(tokens)] = 0
            member[rank[at[tokens[at] == s]], q] = 1
        size = np.array([len(s) for s in mine], dtype=np.int64)
        walk = [(0, len(paths), 0, np.arange(len(mine)), np.zeros(len(mine), dtype=np.int64))]
        while walk:
            low, high, depth, active, overlap = walk.pop()
            first, last = paths[low], paths[high - 1]
            n = min(len(first), len(last))
            differ = np.flatnonzero(first[depth:n] != last[depth:n])
            end = depth + int(differ[0]) if len(differ) else n
            if end > depth:
                overlap = overlap + member[first[depth:end]][:, active].sum(axis=0, dtype=np.int64)
            below = lengths[low:high]
            # the most that can still be shared, against the least that the shortest set below needs
            most = overlap + np.minimum(below.max() - end, size[active] - overlap)
            keep = most >= least_overlap(size[active], below.min(), percent)
            active, overlap = active[keep], overlap[keep]
            if not len(active):
                continue
            while low < high and len(paths[low]) == end:  # sets that end here
                hit = overlap >= least_overlap(size[active], end, percent)
                if hit.any():
                    yield active[hit] + start, np.full(int(hit.sum()), order[low])
                low += 1
            at = low
            while at < high:  # a child for each next shingle
                token = paths[at][end]
                left, right = at, high
                while left < right:
                    mid = (left + right) // 2
                    if paths[mid][end] > token:
                        right = mid
                    else:
                        left = mid + 1
                walk.append((at, left, end, active, overlap))
                at = left


def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Short runs of each batch as lists, so that the texts and shingles of a batch are never held whole."""
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            yield batch.slice(at, TOGETHER).to_pydict()


def set_id(s: np.ndarray) -> int | None:
    """A 64-bit hash of a set as a signed long; none for the empty set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64)) if len(s) else None


def with_set_id(docs: DataFrame, words: int = WORDS, text: str = "text", out: str = "set_id") -> DataFrame:
    """Append the id of each text's shingle set, null without words."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([set_id(shingles(t, words)) for t in texts], dtype="Int64")

    return docs.withColumn(out, of(F.col(text)))


def describe(docs: DataFrame, words: int) -> DataFrame:
    """From one pass over the texts: rows of ``doc_id``, ``sid`` (null without words), ``n`` and ``bitmap``,
    and rows of ``slice`` and ``counts``, the count of shingles by hash bucket."""
    slices = 1 << (BUCKET_BITS - SLICE_BITS)

    schema = pa.schema([
        ("doc_id", pa.int64()), ("sid", pa.int64()), ("n", pa.int64()), ("bitmap", pa.binary()), ("slice", pa.int32()), ("counts", pa.binary())
    ])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
        for run in runs_of(batches):
            sets = [shingles(text, words) for text in run["text"]]
            seen, times = np.unique(np.concatenate(sets) >> np.uint64(64 - BUCKET_BITS), return_counts=True)
            counts[seen.astype(np.int64)] += times
            none = [None] * len(sets)
            yield pa.RecordBatch.from_pydict({
                "doc_id": run["doc_id"], "sid": [set_id(s) for s in sets], "n": [len(s) for s in sets],
                "bitmap": [bitmap(s) if len(s) else None for s in sets], "slice": none, "counts": none,
            }, schema=schema)
        _hashes.clear()
        table = counts.reshape(slices, -1)
        used = [i for i in range(slices) if table[i].any()]
        none = [None] * len(used)
        yield pa.RecordBatch.from_pydict({
            "doc_id": none, "sid": none, "n": none, "bitmap": none, "slice": used, "counts": [table[i].tobytes() for i in used],
        }, schema=schema)

    return docs.select("doc_id", "text").mapInArrow(of, "doc_id long, sid long, n long, bitmap binary, slice int, counts binary")


def partial_counts(described: DataFrame) -> DataFrame:
    """``slice`` and ``counts`` of at most PARTITIONS partitions of ``described`` a row."""
    run = F.floor(F.spark_partition_id() / PARTITIONS)
    rows = described.filter("slice IS NOT NULL").select("slice", "counts", run.alias("run"))
    return rows.groupBy("slice", "run").applyInPandas(add_counts, "slice int, counts binary")


def add_counts(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(1 << SLICE_BITS, dtype=np.int64)
    for b in rows["counts"]:
        total += np.frombuffer(b, dtype=np.int64)
    return pd.DataFrame({"slice": rows["slice"].iloc[:1], "counts": [total.tobytes()]})


def bucket_counts(described: DataFrame) -> np.ndarray:
    """Shingles by hash bucket: a table of 2 ** BUCKET_BITS numbers, whatever the input. Added up in two steps, so that
    a group grows with a fraction of the partitions."""
    table = np.zeros((1 << (BUCKET_BITS - SLICE_BITS), 1 << SLICE_BITS), dtype=np.int64)
    for r in partial_counts(described).groupBy("slice").applyInPandas(add_counts, "slice int, counts binary").collect():
        table[r["slice"]] = np.frombuffer(r["counts"], dtype=np.int64)
    return table.ravel()


def first_shingles(docs: DataFrame, counts: np.ndarray, words: int, percent: int) -> DataFrame:
    """``token`` and ``sid``: the first shingles of each set in the order of rare buckets first."""
    shared = docs.sparkSession.sparkContext.broadcast(counts.astype(np.float32 if counts.max(initial=0) < 2**24 else np.float64))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        for run in runs_of(batches):
            tokens, sids = [], []
            for text in run["text"]:
                s = shingles(text, words)
                if len(s):
                    heavy = weight[(s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
                    first = np.argsort(heavy, kind="stable")[: prefix_length(len(s), percent)]
                    tokens.append(s[first])
                    sids.append(np.full(len(first), set_id(s), dtype=np.int64))
            if tokens:
                yield pa.RecordBatch.from_pydict({"token": np.concatenate(tokens).view(np.int64), "sid": np.concatenate(sids)})
        _hashes.clear()

    return docs.select("text").mapInArrow(of, "token long, sid long")


def blocked(df: DataFrame, group: str, member: str) -> DataFrame:
    """Rows dealt to pairs of blocks ``i <= j`` of their group: ``side`` is 0 for i, 1 for j, 2 for both. Any two
    members of a group meet, and no pair of blocks holds many more than twice BLOCK rows."""
    sizes = df.groupBy(group).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    mine = df.join(sizes, group).withColumn("mine", F.pmod(F.xxhash64(member), F.col("blocks")).cast("int"))
    dealt = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(
        *df.columns, F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).alias("side"),
    )


def candidates(prefixes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a`` and ``b`` that join sets that share a first shingle and may link: a forest per group."""
    again = prefixes.distinct()
    shared = again.groupBy("token").agg(F.count("*").alias("k")).filter("k > 1").select("token")
    meeting = checkpointed(again.join(shared, "token"))
    rows = blocked(meeting, "token", "sid").join(sets.select("sid", "n", "bitmap"), "sid")
    # many small groups go to a call together
    calls = max(rows.sparkSession.sparkContext.defaultParallelism * 4, meeting.count() // CALL_ROWS)
    rows = rows.withColumn("call", F.pmod(F.xxhash64("token", "i", "j"), F.lit(calls)))

    def of(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["token", "i", "j"], kind="stable")
        key = part[["token", "i", "j"]].to_numpy()
        start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)]) if len(part) else np.zeros(0, dtype=np.int64)
        size = np.diff(np.r_[start, len(part)])
        side = part["side"].to_numpy()
        sid, first, place = np.unique(part["sid"].to_numpy(), return_index=True, return_inverse=True)
        maps, n = part["bitmap"].iloc[first].tolist(), part["n"].to_numpy()[first]
        known, forest = Bitmaps(maps, n, percent), Forest(len(sid))
        for k in np.unique(size[size > 1]).tolist():
            groups = start[size == k]
            if k <= FEW:  # all groups of this size together
                x, y = (groups[:, None] + t[None, :] for t in np.triu_indices(k, 1))
                x, y = x.ravel(), y.ravel()
                met = (side[x] == 2) | (side[x] != side[y])
                pairs = np.unique(np.sort(np.stack([place[x[met]], place[y[met]]], axis=1), axis=1), axis=0)
                ok = known.allow(pairs[:, 0], pairs[:, 1])
                for a, b in pairs[ok].tolist():
                    forest.add(a, b)
                continue
            for g in groups.tolist():
                own = place[g : g + k]
                for x, y in may_link([maps[i] for i in own], n[own], percent):
                    met = (side[g + x] == 2) | (side[g + x] != side[g + y])
                    for a, b in zip(own[x[met]].tolist(), own[y[met]].tolist(), strict=True):
                        forest.add(a, b)
        return pd.DataFrame([(sid[a], sid[b]) for a, b in forest.links], columns=["a", "b"], dtype="int64")

    return rows.drop("k").groupBy("call").applyInPandas(of, "a long, b long").distinct()


def links(docs: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """Exact links within clusters, a forest per pair of blocks. ``members``: ``cluster``, ``sid`` and one
    ``doc_id`` that has the set."""
    texts = docs.join(small_side(members), "doc_id").select("cluster", "sid", "text")
    rows = blocked(checkpointed(texts), "cluster", "sid")

    def of(g: pd.DataFrame) -> pd.DataFrame:
        g = g.drop_duplicates(["sid", "text"])
        sets = [shingles(t, words) for t in g["text"]]
        # an id may stand on rows of other texts, which are not the set that is looked for
        own = np.array([set_id(s) == i for s, i in zip(sets, g["sid"], strict=True)], dtype=bool)
        sid, side = g["sid"].to_numpy()[own], g["side"].to_numpy()[own]
        sets = [s for s, ok in zip(sets, own, strict=True) if ok]
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        forest = Forest(len(sets))
        if len(left) and len(right):
            for q, s in tree_join([sets[i] for i in right], [sets[i] for i in left], percent):
                for x, y in zip(left[q].tolist(), right[s].tolist(), strict=True):
                    if x != y:
                        forest.add(x, y)
        return pd.DataFrame([(sid[a], sid[b]) for a, b in forest.links], columns=["a", "b"], dtype="int64")

    return rows.groupBy("cluster", "i", "j").applyInPandas(of, "a long, b long").distinct()


def link_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the smallest id that links lead to, its own included; and
    ``set_id``, the same for equal sets (see :func:`with_set_id`), null without words.

    Two documents link when 100 * intersection >= percent * union of their shingle sets. Documents without
    words (null, empty, white space) have no shingles and link with nothing; nor do rows without an id, whose
    component is null. Each row is returned, repeated ones too; of one id on several texts each text is looked
    at. Other columns are not used; texts are never cut.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    described = checkpointed(describe(base, words))
    rows = described.filter("slice IS NULL").select("doc_id", "sid", "n", "bitmap")
    counts = bucket_counts(described)
    sets = checkpointed(rows.filter("sid IS NOT NULL AND doc_id IS NOT NULL").groupBy("sid").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap")
    ))
    known = base.filter("doc_id IS NOT NULL")
    clusters = components(candidates(first_shingles(known, counts, words, percent), sets, percent))
    members = checkpointed(clusters.select(F.col("component").alias("cluster"), F.col("node").alias("sid")).join(sets.select("sid", "doc_id"), "sid"))
    joined = components(links(known, members, words, percent))
    # the smallest document of each set, then of each component
    labelled = sets.select("sid", "doc_id").join(joined, F.col("sid") == F.col("node"), "left").select(
        "sid", "doc_id", F.coalesce("component", "sid").alias("component")
    )
    smallest = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_set = labelled.join(smallest, "component").select("sid", "component_id")
    return rows.select("doc_id", "sid", "n").join(of_set, "sid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.col("sid").alias("set_id"),
    )
