"""Log probabilities of texts under a trigram model that is kept in Elias-Fano tries.

1. Documents are cut into chunks of whole texts; a chunk keeps its words once and its tokens as places among them.
2. Each chunk's distinct pairs and triples, with their counts in the documents that are learned from, are dealt to shards by the
   pair's first word; a word with very many tokens is dealt on by its next word. A chunk has any triple once, so
   a frequent one is added up before it moves.
3. A shard builds one trie of its triples. A level lists the successors of all contexts as one rising sequence (context times
   vocabulary, plus successor) in Elias-Fano form, and rising pointers say where each context's successors begin. Beside
   each node stands a one-byte code of its smoothed probability. The levels lie in one flat memory map.
4. Queries follow the pointers of their context and search the successor in its range. The answers go back to the chunks, which
   add up the logarithms of their texts.

Smoothing is a chain of Dirichlet priors: ``p(w) = (c + 1) / (N + V + 1)``, ``p(w | v) = (c(vw) + M2 p(w)) / (c(v) + M2)`` and
``p(w | uv) = (c(uvw) + M3 p(w | v)) / (c(uv) + M3)``. The probabilities of all known words and one unknown add up to 1, but for
the one-byte codes, which are exact where a level of a shard has no more than 255 different values. Two begin marks stand before
each text and are no tokens.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import checkpointed, give_back

#: Hashes of the marks that stand before a text and after it; words have others.
BEGIN, END = 0, 1
#: Tokens of a chunk, training tokens of a shard, tokens of a first word that are dealt together.
CHUNK, SHARD, TOGETHER = 2_000_000, 2_000_000, 1_000_000
#: So many of the most frequent words, of those with so many tokens, are sent as numbers, the others as hashes.
COMMON, OFTEN = 1 << 19, 8
#: Bytes of a long text that are split into words at a time.
STRETCH = 1 << 20
#: Strength of the priors of pairs and of triples.
M2, M3 = 40.0, 8.0
#: Codes of a level; 0 says that there is no node.
CODES = 255
#: Fixed value: an odd 64-bit multiplier, the golden ratio's.
MIX = np.uint64(0x9E3779B97F4A7C15)


# -- compact sequences -------------------------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after another behind a list of their types and lengths, each begun at a multiple of 8 bytes."""
    head = np.zeros((len(arrays), 2), dtype="<i8")
    body = []
    for i, a in enumerate(arrays):
        head[i] = int.from_bytes(a.dtype.str.encode().ljust(8), "little"), len(a)
        raw = a.tobytes()
        body += [raw, bytes(-len(raw) % 8)]
    return b"".join([len(arrays).to_bytes(8, "little"), head.tobytes(), *body])


def unpack(raw: bytes | memoryview | mmap.mmap) -> list[np.ndarray]:
    """The arrays of ``pack``, as views."""
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head = np.frombuffer(raw, "<i8", 2 * n, 8).reshape(n, 2)
    at, out = 8 + 16 * n, []
    for kind, length in head.tolist():
        a = np.frombuffer(raw, np.dtype(kind.to_bytes(8, "little").decode().strip()), length, at)
        out.append(a)
        at += a.nbytes + (-a.nbytes % 8)
    return out


def _planes(a: np.ndarray) -> np.ndarray:
    """Bytes of like weight side by side, which compress better."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T)


def shrink(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers, compressed, for what is stored or sent."""
    kinds = np.frombuffer(b"".join(a.dtype.str.encode().ljust(8) for a in arrays), np.uint8)
    return zstandard.ZstdCompressor(level=3).compress(pack(kinds, *[_planes(a).ravel() for a in arrays]))


def swell(raw: bytes) -> list[np.ndarray]:
    kinds, *planes = unpack(zstandard.ZstdDecompressor().decompress(raw))
    types = [np.dtype(kinds[i : i + 8].tobytes().decode().strip()) for i in range(0, len(kinds), 8)]
    return [np.ascontiguousarray(p.reshape(t.itemsize, -1).T).view(t).ravel() for p, t in zip(planes, types, strict=True)]


def narrow(a: np.ndarray) -> np.ndarray:
    """In the smallest unsigned type that holds all values."""
    return a.astype(np.min_scalar_type(int(a.max(initial=0))))


@dataclass
class Rising:
    """A sequence that never falls, in Elias-Fano form: ``width`` low bits of each value side by side, the rest in unary."""

    n: int
    width: int
    low: np.ndarray
    high: np.ndarray
    ones: np.ndarray = field(init=False)
    zeros: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.ones = np.cumsum(np.bitwise_count(self.high), dtype=np.int64)
        self.zeros = 64 * np.arange(1, len(self.high) + 1) - self.ones

    @classmethod
    def of(cls, values: np.ndarray) -> Rising:
        values = values.astype(np.int64)
        n = len(values)
        if not n:
            return cls(0, 0, np.zeros(2, np.uint64), np.zeros(1, np.uint64))
        width = max(0, (int(values[-1]) // n).bit_length() - 1)
        low = np.zeros((-(-n * width // 64) + 2) * 64, dtype=np.uint8)
        for bit in range(width):
            low[bit : n * width : width] = (values >> bit) & 1
        at = (values >> width) + np.arange(n)
        high = np.zeros((int(at[-1]) // 64 + 1) * 64, dtype=np.uint8)
        high[at] = 1
        words = lambda bits: np.packbits(bits, bitorder="little").view(np.uint64)
        return cls(n, width, words(low), words(high))

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.width], dtype=np.int64), self.low, self.high]

    @classmethod
    def read(cls, parts: list[np.ndarray]) -> Rising:
        (n, width), low, high = parts
        return cls(int(n), int(width), low, high)

    @staticmethod
    def _select(words: np.ndarray, ranks: np.ndarray, k: np.ndarray, flip: bool = False) -> np.ndarray:
        """Positions of the k-th set bits, or of the k-th others; ``ranks`` counts them up to the end of each word."""
        word = np.searchsorted(ranks, k, side="right")
        left = k - np.where(word > 0, ranks[word - 1], 0)
        bits, at = ~words[word] if flip else words[word], word * 64
        for step in (32, 16, 8, 4, 2, 1):
            here = np.bitwise_count(bits & np.uint64((1 << step) - 1)).astype(np.int64)
            on = left >= here
            left -= here * on
            at += step * on
            bits = bits >> (on * np.uint64(step))
        return at

    def _low(self, i: np.ndarray) -> np.ndarray:
        start = i * self.width
        word, shift = start >> 6, (start & 63).astype(np.uint64)
        above = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (((self.low[word] >> shift) | above) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """Values at the places ``i``."""
        return ((self._select(self.high, self.ones, i) - i) << self.width) | self._low(i)

    def _begin(self, high: np.ndarray) -> np.ndarray:
        """How many values have high bits below these."""
        inside = (high > 0) & (high <= self.zeros[-1])
        out = np.where(high > 0, self.n, 0)
        out[inside] = self._select(self.high, self.zeros, high[inside] - 1, flip=True) - (high[inside] - 1)
        return out

    def _end(self, high: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Where the runs of values with these high bits end: at the next unset bit, mostly in the same word."""
        at = np.minimum(begin + high, 64 * len(self.high) - 1)
        bits = self.high[at >> 6] >> (at & 63).astype(np.uint64)
        run = np.bitwise_count(bits & ~(bits + np.uint64(1))).astype(np.int64)
        out = np.minimum(begin + run, self.n)
        far = np.flatnonzero(run == 64 - (at & 63))
        out[far] = self._begin(high[far] + 1)
        return out

    def values(self) -> np.ndarray:
        """The whole sequence, read in one go."""
        at = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        i = np.arange(self.n)
        return ((at - i) << self.width) | self._low(i)

    def find(self, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Place of each value between ``low`` and ``high``, -1 where it is not: its high bits name a short run, the low bits are searched there."""
        out = np.full(len(values), -1)
        part, wanted = values >> self.width, values & ((1 << self.width) - 1)
        begin = self._begin(part)
        low, high = np.maximum(low, begin), np.minimum(high, self._end(part, begin))
        open_ = np.flatnonzero(low < high)
        low, high, wanted = low[open_], high[open_], wanted[open_]
        while len(open_):
            middle = (low + high) >> 1
            value = self._low(middle)
            hit = value == wanted
            out[open_[hit]] = middle[hit]
            low, high = np.where(value < wanted, middle + 1, low), np.where(value < wanted, high, middle)
            on = np.flatnonzero(~hit & (low < high))
            open_, low, high, wanted = open_[on], low[on], high[on], wanted[on]
        return out


def coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(codes, book)``: numbers from 1 and the value that each stands for; evenly filled where there are too many values."""
    book = np.unique(values)
    if len(book) > CODES:
        book = np.unique(np.quantile(values, (np.arange(CODES) + 0.5) / CODES))
    codes = np.searchsorted((book[1:] + book[:-1]) / 2, values) + 1
    return codes.astype(np.uint8), np.concatenate([[-np.inf], book])


# -- the trie of a shard -----------------------------------------------------------------------------------


class Trie:
    """Words, pairs and triples of a shard in one memory map."""

    def __init__(self, raw: bytes):
        self.map = mmap.mmap(-1, len(raw))  # anonymous, for a worker's own disk is not ours to fill
        self.map.write(raw)
        a = unpack(self.map)
        self.words = a[0]
        self.counts, self.to_pairs, self.pairs, self.to_triples, self.triples = (Rising.read(a[1 + 3 * i : 4 + 3 * i]) for i in range(5))
        self.pair_codes, self.prior_codes, self.triple_codes = a[16:19]
        self.books = a[19:22]

    @staticmethod
    def build(words: np.ndarray, pairs: np.ndarray, n_pairs: np.ndarray, triples: np.ndarray, n_triples: np.ndarray, known: dict[int, int]) -> bytes:
        """From rising keys of pairs (place of the first word times words, plus the second's) and of triples (place of the pair times words,
        plus the third's), with counts; those that were never met are left out. ``known`` has the counts of
        first words of which other shards hold a part."""
        v = len(words)
        met = n_triples > 0
        parent, third, n_triples = triples[met] // v, triples[met] % v, n_triples[met]
        seen = n_pairs > 0
        seen[parent] = True  # the two begin marks are a context, but no token's pair
        place = np.cumsum(seen) - 1
        pairs, n_pairs, parent = pairs[seen], n_pairs[seen], place[parent]
        head = pairs // v
        counts = np.bincount(head, n_pairs, v).astype(np.int64)
        for word, n in known.items():
            at = np.searchsorted(words, np.uint64(word))
            if at < v and words[at] == np.uint64(word):
                counts[at] = n
        after = np.bincount(parent, n_triples, len(pairs))
        begins = lambda of, n: np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))])
        chances = (np.maximum(n_pairs, 1) / (counts[head] + M2), M3 / (after + M3), n_triples / (after[parent] + M3))
        codes = [coded(np.log10(x)) for x in chances]
        levels = [np.concatenate([[0], np.cumsum(counts)]), begins(head, v), pairs, begins(parent, len(pairs)), parent * v + third]
        parts = [p for level in levels for p in Rising.of(level).parts()]
        return pack(words, *parts, *[c for c, _ in codes], *[b for _, b in codes])

    def count(self, word: np.ndarray) -> np.ndarray:
        return np.diff(self.counts.values())[word]

    def _find(self, level: Rising, begins: Rising, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Place of each successor in its context's range; -1 where it is none. Best asked in rising order, so that memory is read along."""
        at = begins.values().__getitem__ if 4 * len(context) > begins.n else begins.__getitem__
        return level.find(context * len(self.words) + successor, at(context), at(context + 1))

    def answer(self, first: np.ndarray, second: np.ndarray, of: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of pairs, of their priors' weights, and of the triples that extend them."""
        pair = self._find(self.pairs, self.to_pairs, first, second)
        code = lambda codes, at: np.where(at >= 0, codes[at], 0).astype(np.uint8) if len(codes) else np.zeros(len(at), np.uint8)
        triple = np.full(len(of), -1)
        inside = np.flatnonzero(pair[of] >= 0)
        triple[inside] = self._find(self.triples, self.to_triples, pair[of[inside]], third[inside])
        return code(self.pair_codes, pair), code(self.prior_codes, pair), code(self.triple_codes, triple)


# -- chunks ------------------------------------------------------------------------------------------------


def _stretches(text: str | None) -> Iterator[list[bytes]]:
    """Words of a text, A-Z in lower case; a long one in stretches that end at white space."""
    raw = (text or "").encode().lower()
    at = 0
    while at < len(raw):
        end = min(at + STRETCH, len(raw))
        while end < len(raw) and raw[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield raw[at:end].split()
        at = end


CHUNKS = pa.schema([("chunk", pa.int64()), ("body", pa.binary())])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``doc_id``, ``learned`` and ``text`` as chunks: tokens of all texts, their lengths, words."""

    class Places(dict):
        def __missing__(self, word: bytes) -> int:
            self[word] = n = len(self)
            return n

    marks = {BEGIN: BEGIN, END: END}  # words are bytes, so no word is a mark
    chunk, size = TaskContext.get().partitionId() << 32, 0
    places, tokens, lengths, ids, learned = Places(marks), [], [], [], []

    def ready() -> pa.RecordBatch:
        words = np.fromiter((max(2, xxhash.xxh3_64_intdigest(w)) for w in list(places)[2:]), dtype=np.uint64, count=len(places) - 2)
        body = shrink(
            np.concatenate([np.array([BEGIN, END], np.uint64), words]), narrow(np.concatenate(tokens)), np.array(lengths, np.int64),
            np.array(learned, np.bool_), np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids], np.bool_),
        )
        return pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([body])], schema=CHUNKS)

    for batch in batches:
        for i in range(batch.num_rows):
            n = 3
            tokens.append(np.array([BEGIN, BEGIN], np.uint32))
            for words in _stretches(batch.column(2)[i].as_py()):
                tokens.append(np.fromiter(map(places.__getitem__, words), dtype=np.uint32, count=len(words)))
                n += len(words)
            tokens.append(np.array([END], np.uint32))
            lengths.append(n)
            ids.append(batch.column(0)[i].as_py())
            learned.append(batch.column(1)[i].as_py())
            size += n
            if size >= CHUNK:
                yield ready()
                chunk, size = chunk + 1, 0
                places, tokens, lengths, ids, learned = Places(marks), [], [], [], []
    if lengths:
        yield ready()
    del places, tokens
    give_back()


@dataclass
class Chunk:
    """A chunk's distinct pairs and triples, and where its tokens point."""

    words: np.ndarray
    tokens: np.ndarray
    lengths: np.ndarray
    learned: np.ndarray
    ids: np.ndarray
    no_id: np.ndarray

    @classmethod
    def read(cls, body: bytes) -> Chunk:
        words, tokens, *rest = swell(body)
        return cls(words, tokens.astype(np.int64), *rest)

    def __post_init__(self) -> None:
        ends = np.cumsum(self.lengths)
        after = np.ones(len(self.tokens), dtype=bool)
        after[ends - self.lengths] = after[ends - self.lengths + 1] = False
        self.place = np.flatnonzero(after)  # of the tokens, marks before a text left out
        self.text = np.repeat(np.arange(len(self.lengths)), self.lengths - 2)
        self.counts = self.learned[self.text]

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.place[self.counts]], minlength=len(self.words))

    def index(self) -> None:
        n, t = len(self.words), self.tokens
        pair_key = t[:-1] * n + t[1:]
        pair_key[np.cumsum(self.lengths)[:-1] - 1] = BEGIN * n + BEGIN  # from one text to the next: no pair, stands for another
        self.pairs, at = np.unique(pair_key, return_inverse=True)
        self.context, self.pair = at[self.place - 2], at[self.place - 1]
        self.triples, self.triple = np.unique(self.context * n + t[self.place], return_inverse=True)
        self.n_pair = np.bincount(self.pair, self.counts, len(self.pairs)).astype(np.int64)
        self.n_triple = np.bincount(self.triple, self.counts, len(self.triples)).astype(np.int64)

    def deal(self, shards: int, hot: dict[int, int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(shard, places of pairs, places of triples)``; the pairs of a hot word go by their second word too."""
        n = len(self.words)
        first, second = self.pairs // n, self.pairs % n
        share = np.array([hot.get(w, 1) for w in self.words.tolist()], dtype=np.uint64) if hot else np.ones(n, np.uint64)
        h = self.words * MIX
        h ^= h >> np.uint64(31)
        key = (self.words[first] + (h[second] % share[first])) * MIX
        key = (key ^ (key >> np.uint64(29))) * MIX
        shard = ((key >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)
        of = shard[self.triples // n]
        by, by_triple = np.argsort(shard, kind="stable"), np.argsort(of, kind="stable")
        here = np.unique(shard)
        low, high = np.searchsorted(shard[by], here), np.searchsorted(shard[by], here, side="right")
        low3, high3 = np.searchsorted(of[by_triple], here), np.searchsorted(of[by_triple], here, side="right")
        for i, s in enumerate(here.tolist()):
            yield s, by[low[i] : high[i]], by_triple[low3[i] : high3[i]]

    def ranks(self, common: np.ndarray) -> np.ndarray:
        """Place of every word among the frequent ones; -1 for the others."""
        if not len(common):
            return np.full(len(self.words), -1)
        rank = np.minimum(np.searchsorted(common, self.words), len(common) - 1)
        return np.where(common[rank] == self.words, rank, -1)

    def query(self, pairs: np.ndarray, triples: np.ndarray, ranks: np.ndarray) -> bytes:
        """Pairs and triples with counts, in words of their own: what a shard learns from and answers."""
        n = len(self.words)
        first, second, third = self.pairs[pairs] // n, self.pairs[pairs] % n, self.triples[triples] % n
        used = np.zeros(n, dtype=bool)
        used[first] = used[second] = used[third] = True
        slots = np.flatnonzero(used)
        rank = ranks[slots]
        slots = slots[np.argsort(rank, kind="stable")]  # words that are not frequent come first
        rank = np.sort(rank[rank >= 0])
        rare = len(slots) - len(rank)
        at = np.zeros(n, dtype=np.int64)
        at[slots] = np.arange(len(slots))
        own = np.bincount(np.searchsorted(pairs, self.triples[triples] // n), minlength=len(pairs))
        return shrink(self.words[slots[:rare]], narrow(np.diff(rank, prepend=0)), *[narrow(x) for x in (at[first], at[second], self.n_pair[pairs], own, at[third], self.n_triple[triples])])


class Shard:
    """The queries of all chunks to one shard, over one vocabulary, each pair and triple once."""

    def __init__(self, queries: list[bytes], common: np.ndarray):
        words, firsts, seconds, thirds, owns, counts, met = [], [], [], [], [], [], []
        for query in queries:
            rare, steps, first, second, n_pair, own, third, n_triple = swell(query)
            words.append(np.concatenate([rare, common[np.cumsum(steps, dtype=np.int64)]]))
            firsts.append(first), seconds.append(second), thirds.append(third)
            owns.append(own), counts.append(n_pair), met.append(n_triple)
        self.words = np.unique(np.concatenate(words))
        v = len(self.words)
        places = [np.searchsorted(self.words, w) for w in words]
        key = np.concatenate([p[a] * v + p[b] for p, a, b in zip(places, firsts, seconds, strict=True)])
        self.heads = [p[a[np.concatenate([[True], a[1:] != a[:-1]])]] for p, a in zip(places, firsts, strict=True)]  # in each chunk's order
        self.pairs, self.pair = np.unique(key, return_inverse=True)
        self.n_pairs = np.bincount(self.pair, np.concatenate(counts), len(self.pairs)).astype(np.int64)
        key = np.repeat(self.pair, np.concatenate(owns)) * v + np.concatenate([p[c] for p, c in zip(places, thirds, strict=True)])
        self.triples, self.triple = np.unique(key, return_inverse=True)
        self.n_triples = np.bincount(self.triple, np.concatenate(met), len(self.triples)).astype(np.int64)
        self.ends = np.cumsum([len(a) for a in firsts]), np.cumsum([len(c) for c in thirds])

    def trie(self, known: dict[int, int]) -> bytes:
        return Trie.build(self.words, self.pairs, self.n_pairs, self.triples, self.n_triples, known)

    def answers(self, trie: Trie) -> Iterator[bytes]:
        """What each chunk asked, from one search of every pair and triple."""
        v = len(self.words)
        place = np.searchsorted(trie.words, self.words)
        of_pair, of_prior, of_triple = trie.answer(place[self.pairs // v], place[self.pairs % v], self.triples // v, place[self.triples % v])
        counts = trie.count(place)
        low = low3 = 0
        for heads, high, high3 in zip(self.heads, *self.ends, strict=True):
            pair, triple = self.pair[low:high], self.triple[low3:high3]
            yield shrink(counts[heads], of_pair[pair], of_prior[pair], of_triple[triple], *trie.books)
            low, low3 = high, high3


# -- the corpus --------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Sizes:
    """Training tokens, distinct ones, training texts, shards, counts of the first words that several shards share, and
    the most frequent words (sorted hashes)."""

    tokens: int
    words: int
    texts: int
    shards: int
    hot: dict[int, int]
    common: np.ndarray

    @property
    def shares(self) -> dict[int, int]:
        return {w: -(-n // TOGETHER) for w, n in self.hot.items()}


def chunked(docs: DataFrame, learn: Column, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored chunks of all documents. ``learn`` says which ones are learned from."""
    given = docs.select(F.col(row_id).cast("long"), F.coalesce(learn, F.lit(True)), F.col(text))
    return checkpointed(given.mapInArrow(_chunks, "chunk long, body binary"))


def measured(chunks: DataFrame) -> Sizes:
    """Counts of the whole corpus. Each chunk sends its words in ranges of their hashes, which are added up range by range. To the
    driver come words of more than TOGETHER tokens, at most tokens / TOGETHER, and the COMMON most frequent ones."""
    ranges = np.uint64(max(16, chunks.count()))

    def sorted_words(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for body in part["body"]:
                chunk = Chunk.read(body)
                n = chunk.word_counts()
                if not n.any():
                    continue
                met = np.flatnonzero(n)[np.argsort(chunk.words[n > 0])]
                words, n = chunk.words[met], n[met]
                place = ((words >> np.uint64(32)) * ranges >> np.uint64(32)).astype(np.int64)
                here, low = np.unique(place, return_index=True)
                cut = zip(here.tolist(), low.tolist(), [*low.tolist()[1:], len(place)], strict=True)
                rows = [(r, shrink(np.diff(words[i:j], prepend=np.uint64(0)), narrow(n[i:j]))) for r, i, j in cut]
                yield pd.DataFrame(rows, columns=["range", "words"])
        give_back()

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        steps, counts = zip(*map(swell, rows["words"]), strict=True)
        words, at = np.unique(np.concatenate([np.cumsum(s, dtype=np.uint64) for s in steps]), return_inverse=True)
        n = np.bincount(at, np.concatenate(counts), len(words)).astype(np.int64)
        often = (n >= OFTEN) | (words == END)
        out = pd.DataFrame({"word": pd.array(words[often].view(np.int64), dtype="Int64"), "n": n[often], "distinct": 0})
        return pd.concat([out, pd.DataFrame({"word": pd.array([None], dtype="Int64"), "n": [n.sum()], "distinct": [len(words)]})])

    sent = chunks.select("body").mapInPandas(sorted_words, "range long, words binary")
    counted = checkpointed(sent.groupBy("range").applyInPandas(add, "word long, n long, distinct long"))
    nothing, ends = F.lit(0), F.when(F.col("word") == END, F.col("n"))
    every = F.when(F.col("word").isNull(), F.col("n"))
    tokens, distinct, texts = counted.agg(*[F.coalesce(F.sum(c), nothing) for c in (every, F.col("distinct"), ends)]).first()
    often = counted.filter(F.col("word").isNotNull() & ~F.col("word").isin(BEGIN, END))
    known = {int(r["word"]) & (2**64 - 1): int(r["n"]) for r in often.filter(F.col("n") > TOGETHER).collect()}
    if texts > TOGETHER:  # every text begins one pair
        known[BEGIN] = int(texts)
    # as many of the most frequent as fit, by classes of like counts: at most a few hundred rows
    size = F.floor(F.log2("n") * 8)
    classes = often.groupBy(size.alias("size")).agg(F.count("*").alias("m"), F.min("n").alias("low")).orderBy(F.desc("size")).collect()
    fits, low = 0, None
    for c in classes:
        fits += c["m"]
        if fits > COMMON:
            break
        low = c["low"]
    frequent = often.filter(F.col("n") >= low).select("word").toPandas()["word"].to_numpy(np.int64) if low else np.array([], np.int64)
    return Sizes(int(tokens), int(distinct), int(texts), max(1, -(-int(tokens) // SHARD)), known, np.sort(frequent.view(np.uint64)))


def queries(chunks: DataFrame, sizes: Sizes) -> DataFrame:
    """``chunk``, ``shard`` and the ``query`` of each chunk to each shard that it needs."""
    shards, shares, common = sizes.shards, sizes.shares, sizes.common

    def ask(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at, body in zip(part["chunk"], part["body"], strict=True):
                chunk = Chunk.read(body)
                chunk.index()
                ranks = chunk.ranks(common)
                rows = [(at, s, chunk.query(p, t, ranks)) for s, p, t in chunk.deal(shards, shares)]
                yield pd.DataFrame(rows, columns=["chunk", "shard", "query"])
                del chunk, rows
        give_back()

    return chunks.mapInPandas(ask, "chunk long, shard long, query binary")


def model(docs: DataFrame, row_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, Sizes]:
    """The tries that documents teach, one row per ``shard``, and the corpus counts they belong to."""
    chunks = chunked(docs, F.lit(True), row_id, text)
    sizes = measured(chunks)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": rows["shard"][:1], "trie": [Shard(list(rows["query"]), sizes.common).trie(sizes.hot)]})

    return queries(chunks, sizes).groupBy("shard").applyInPandas(build, "shard long, trie binary"), sizes


def text_scores(docs: DataFrame, learn: Column, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``held_out`` (not learned from), ``n_tokens``, ``n_known`` (tokens met in training), ``train_tokens``, ``base_score`` and
    ``score`` of every whole text, a null text counting as empty.

    Base: the sum of ``log10((c + 1) / (N + V + 1))`` over the text's tokens. Score: the same of the trigram model. Every row is a text
    of its own, also rows of equal or null id; rows for which ``learn`` is null are learned from. Without any text to learn from both
    scores are 0. An empty table gives no rows. Other columns are not used, whatever their names.
    """
    chunks = chunked(docs, learn, row_id, text)
    sizes = measured(chunks)

    def reply(rows: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(list(rows["query"]), sizes.common)
        trie = Trie(shard.trie(sizes.hot))
        give_back()
        return pd.DataFrame({"chunk": rows["chunk"].to_numpy(), "shard": rows["shard"].to_numpy(), "answer": list(shard.answers(trie))})

    answers = queries(chunks, sizes).groupBy("shard").applyInPandas(reply, "chunk long, shard long, answer binary")
    shares = sizes.shares

    def score(mine: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        chunk = Chunk.read(mine["body"].iloc[0])
        chunk.index()
        n = len(chunk.words)
        c = np.zeros(n, dtype=np.int64)
        pair, prior, triple = np.zeros(len(chunk.pairs)), np.ones(len(chunk.pairs)), np.zeros(len(chunk.triples))
        given = dict(zip(replies["shard"].tolist(), replies["answer"], strict=True))
        for shard, pairs, triples in chunk.deal(sizes.shards, shares):
            counts, of_pair, of_prior, of_triple, *books = swell(given[shard])
            c[np.unique(chunk.pairs[pairs] // n)] = counts
            pair[pairs], triple[triples] = 10.0 ** books[0][of_pair], 10.0 ** books[2][of_triple]
            prior[pairs] = np.where(of_prior > 0, 10.0 ** books[1][of_prior], 1.0)
        c[BEGIN] = c[END] = sizes.texts
        give_back()
        token, before = chunk.tokens[chunk.place], chunk.tokens[chunk.place - 1]
        one = (c[token] + 1) / (sizes.tokens + sizes.words + 1)
        two = pair[chunk.pair] + M2 / (c[before] + M2) * one
        three = triple[chunk.triple] + prior[chunk.context] * two
        total = lambda x: np.bincount(chunk.text, x, len(chunk.ids))
        return pd.DataFrame({
            "doc_id": pd.arrays.IntegerArray(chunk.ids.copy(), chunk.no_id.copy()), "held_out": ~chunk.learned, "n_tokens": chunk.lengths - 2,
            "n_known": total(c[token] > 0).astype(np.int64), "train_tokens": sizes.tokens,
            "base_score": total(np.log10(one)), "score": total(np.log10(three)),
        })

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(score, schema)
