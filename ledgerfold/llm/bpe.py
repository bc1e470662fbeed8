"""Byte-level BPE encoding and decoding with a published vocabulary.

Encoding takes the longest vocabulary match at each place, found for a whole piece by an
Aho-Corasick automaton, and keeps it only if it is compatible with the token before it; otherwise
it shortens the match or steps back. A sequence of pairwise compatible tokens is the one that merging
in rank order gives, so the result is exact and no merge is replayed. Decoding gathers bytes through
an offset table.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import without

#: How this family of tokenizers cuts a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pieces up to so many letters are remembered, in two generations of so many pieces.
KEPT_LETTERS, KEPT_PIECES = 40, 150_000
#: Texts whose ids a worker holds at once.
TOGETHER = 500

INFINITE = 1 << 60


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Kept(dict):
    """What was made of recent pieces. A full generation becomes the old one, whose pieces return when
    they are asked for, so frequent ones stay and memory is bounded."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, piece: str):
        found = self.old.get(piece)
        if found is None:
            found = self.make(piece)
        if len(piece) <= KEPT_LETTERS:
            if len(self) >= KEPT_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = found
        return found


class Tokenizer:
    """A vocabulary, its merge ranks and the tables that encoding and decoding use."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        raw = {t: bytes(letters[c] for c in t) for t in vocab}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for t, i in vocab.items():
            self.bytes_of[i] = raw[t]
        for t, i in self.specials.items():
            self.bytes_of[i] = t.encode()
        # rank of each merge, what it makes, and the two parts of each token
        self.merge_rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made = [-1] * size
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            whole = vocab[a + b]
            self.merge_rank[vocab[a], vocab[b]] = rank
            if whole not in self.parts:
                self.parts[whole] = (vocab[a], vocab[b])
                self.made[whole] = rank
        # Latin-1 text stands for bytes, since the automaton takes text
        self.automaton = ahocorasick.Automaton()
        ids = {raw[t]: i for t, i in vocab.items()}
        for b, i in ids.items():
            self.automaton.add_word(b.decode("latin-1"), (len(b), i))
        self.automaton.make_automaton()
        self.shorter = [-1] * size  # the longest token that begins another one
        for b, i in ids.items():
            for n in range(len(b) - 1, 0, -1):
                if (j := ids.get(b[:n])) is not None:
                    self.shorter[i] = j
                    break
        self.length = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.length)])
        self.blob = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.find = regex.compile(PIECES).findall
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True))) if self.specials else None
        self.pairs: dict[tuple[int, int], bool] = {}
        self.kept = Kept(lambda piece: array("i", self.encode_piece(piece.encode())).tobytes())
        self.decimal = [str(i) for i in range(size)]

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens at one edge of a token as it grew, each with the rank of the merge that took it up."""
        out, until = [], INFINITE
        while True:
            out.append((token, until))
            if token not in self.parts:
                return out
            until, token = self.made[token], self.parts[token][side]

    def compatible(self, a: int, b: int) -> bool:
        """Do these tokens stay apart when merged side by side?

        They don't if some merge joins an edge of the first and an edge of the second while both are
        there. Of equal ranks the left pair goes first.
        """
        known = self.pairs.get((a, b))
        if known is None:
            rank = self.merge_rank.get
            known = not any(
                (r := rank((x, y))) is not None and r < x_until and r <= y_until
                for x, x_until in self.spine(a, 1)
                for y, y_until in self.spine(b, 0)
            )
            if len(self.pairs) >= 2 * KEPT_PIECES:
                self.pairs.clear()
            self.pairs[a, b] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        n = len(piece)
        longest = [(0, -1)] * n
        for end, found in self.automaton.iter(piece.decode("latin-1")):
            start = end + 1 - found[0]
            if found[0] > longest[start][0]:
                longest[start] = found
        dead = bytearray(n + 1)  # places that no sequence can go on from
        out: list[int] = []
        at, token = 0, longest[0][1]
        bytes_of = self.bytes_of
        while True:
            end = at + len(bytes_of[token])
            if not dead[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                if at == n:
                    return out
                token = longest[at][1]
                continue
            token = self.shorter[token]
            while token < 0:
                dead[at] = 1
                last = out.pop()
                at -= len(bytes_of[last])
                token = self.shorter[last]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        if self.special and self.special.search(text):
            packed, at = [], 0
            for m in [*self.special.finditer(text), None]:
                packed += map(self.kept.__getitem__, self.find(text[at : m.start() if m else None]))
                if m:
                    packed.append(array("i", [self.specials[m[0]]]).tobytes())
                    at = m.end()
        else:
            packed = map(self.kept.__getitem__, self.find(text))
        return np.frombuffer(b"".join(packed), dtype=np.int32)

    def spelled(self, ids: np.ndarray) -> str:
        """Decimal ids joined by commas."""
        decimal = self.decimal
        return ",".join([decimal[i] for i in ids.tolist()])

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.length[ids]
        ends = np.cumsum(lengths)
        if not len(ends):
            return b""
        shift = np.repeat(self.offset[ids] - (ends - lengths), lengths)
        return self.blob[shift + np.arange(ends[-1])].tobytes()


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """One per process and vocabulary, for use outside Spark tasks."""
    return Tokenizer(path)


def pieces_of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Short runs of each batch, so that what is made of a batch is never held whole."""
    for part in parts:
        for at in range(0, max(1, len(part)), TOGETHER):
            yield part.iloc[at : at + TOGETHER]


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Append an ``array<int>`` of token ids of each whole text; null counts as empty.

    Strings of special tokens in a text become those tokens, as the file says. Other columns stay,
    one of the name ``ids`` is replaced. ``path`` must be readable on every executor.
    """

    @F.pandas_udf("array<int>")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = Tokenizer(path)  # a worker that goes on to other work keeps none of it
        for part in pieces_of(parts):
            yield pd.Series([t.encode(x or "") for x in part], dtype=object)

    return df.select(*without(df, ids), of(F.col(text)).alias(ids))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """The reverse of ``encode``: text of each list of ids; null counts as empty. Bytes that are no
    UTF-8 become U+FFFD."""

    @F.pandas_udf("string")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = Tokenizer(path)  # a worker that goes on to other work keeps none of it
        for part in parts:
            yield pd.Series([
                t.decode(np.asarray([] if x is None else x, dtype=np.int64)).decode("utf-8", "replace") for x in part
            ], dtype=object)

    return df.select(*without(df, text), of(F.col(ids)).alias(text))


def digests(df: DataFrame, path: str, text: str = "text", ids: str | None = None) -> DataFrame:
    """Append ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by commas) and
    ``decoded_sha256`` (of the text that decoding the ids gives), and the ids themselves where a name is
    given for them.

    Null and empty texts have no tokens; repeated rows are encoded alike. Columns of these names are
    replaced.
    """
    named = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"} | ({ids: "array<int>"} if ids else {})

    @F.pandas_udf(", ".join(f"{n} {t}" for n, t in named.items()))
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        t = Tokenizer(path)  # a worker that goes on to other work keeps none of it
        for part in pieces_of(parts):
            rows = []
            for x in part:
                found = t.encode(x or "")
                said, decoded = t.spelled(found).encode(), t.decode(found)
                rows.append((len(found), hashlib.sha256(said).hexdigest(), hashlib.sha256(decoded).hexdigest(), found)[: len(named)])
            yield pd.DataFrame(rows, columns=list(named))

    return df.withColumn("__bpe", of(F.col(text))).select(*without(df, *named), "__bpe.*")
