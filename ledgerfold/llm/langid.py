"""Language of a text by a byte convolutional network.

Filters of several widths slide over the bytes of fixed-length windows, each filter keeps its largest
value in the window, and a softmax layer turns these into languages. The network is trained here, in
numpy, on a bounded sample of labelled rows. A text's languages are the mean over all its windows,
weighted by their letters.

A filter of width w is a sum of w tables indexed by byte. Tables for pairs of bytes are laid out once a
worker, so a place costs one or two row lookups per width.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.common import without

#: Filter widths in bytes, filters of each, and bytes of a window.
WIDTHS, FILTERS, WINDOW = (2, 3, 4), 16, 256
#: Training takes at most so many texts of each language from each of so many hashed shares of the rows, and of a long
#: text so many passages of WINDOW letters, wherever in it they are.
SAMPLE_TEXTS, SHARES, PASSAGES = 16, 32, 4
STEPS, BATCH, RATE = 500, 64, 0.01
#: Windows looked at together.
CHUNK = 512

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def folding() -> np.ndarray:
    """Bytes to bytes: capitals to small letters, digits to 0, white space and controls to a space."""
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    fold[48:58] = 48
    fold[:33] = 32
    return fold


FOLD = folding()
#: Bytes that letters are made of, for weighing windows.
LETTERS = np.array([(97 <= b <= 122) or b >= 0xC3 for b in range(256)])


@dataclass(frozen=True)
class Network:
    """``tables[w]`` has shape (w, 256, FILTERS); ``out`` maps pooled filters to languages."""

    languages: tuple[str, ...]
    tables: tuple[bytes, ...]
    bias: bytes
    out: bytes
    out_bias: bytes


def arrays(net: Network) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    take = lambda b: np.frombuffer(b, dtype=np.float32)
    tables = [take(t).reshape(w, 256, FILTERS) for w, t in zip(WIDTHS, net.tables, strict=True)]
    n = FILTERS * len(WIDTHS)
    return tables, take(net.bias), take(net.out).reshape(n, len(net.languages)), take(net.out_bias)


def windows(data: np.ndarray) -> np.ndarray:
    """All bytes in rows of WINDOW and the few bytes after it; spaces fill the end."""
    n, extra = max(1, -(-len(data) // WINDOW)), max(WIDTHS) - 1
    padded = np.full(n * WINDOW + extra, 32, dtype=np.uint8)
    padded[: len(data)] = data
    return np.lib.stride_tricks.as_strided(padded, (n, WINDOW + extra), (WINDOW, 1))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], seed: int = 7) -> Network | None:
    """Fit by Adam on random windows, each language drawn equally often. ``None`` without texts."""
    languages = tuple(sorted(set(labels)))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    by = [[] for _ in languages]
    for t, label in zip(texts, labels, strict=True):
        by[languages.index(label)].append(FOLD[windows(np.frombuffer(t.encode(), dtype=np.uint8))])
    by = [np.concatenate(x) for x in by]
    k, n = len(languages), FILTERS * len(WIDTHS)
    weights = [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    weights += [np.zeros(n, np.float32), rng.normal(0, 0.2, (n, k)).astype(np.float32), np.zeros(k, np.float32)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, STEPS + 1):
        y = rng.integers(0, k, BATCH)
        x = np.stack([by[c][rng.integers(0, len(by[c]))] for c in y]).astype(np.int64)
        # the part of a window that is looked at varies, so short texts are known too
        cut = rng.integers(32, WINDOW + 1, BATCH)
        x[np.arange(x.shape[1])[None, :] >= cut[:, None]] = 32
        pooled, best = [], []
        for w, t in zip(WIDTHS, weights, strict=False):
            z = sum(t[i][x[:, i : i + WINDOW]] for i in range(w))
            best.append(z.argmax(axis=1))
            pooled.append(np.take_along_axis(z, best[-1][:, None, :], axis=1)[:, 0, :])
        pre = np.concatenate(pooled, axis=1) + weights[-3]
        hidden = np.maximum(pre, 0)
        p = softmax(hidden @ weights[-2] + weights[-1])
        p[np.arange(BATCH), y] -= 1
        p /= BATCH
        back = (p @ weights[-2].T) * (pre > 0)
        grads = []
        for j, w in enumerate(WIDTHS):
            g, part = np.zeros_like(weights[j]), back[:, j * FILTERS : (j + 1) * FILTERS]
            rows, cols = np.arange(BATCH)[:, None], np.arange(FILTERS)[None, :]
            for i in range(w):
                np.add.at(g[i], (x[rows, best[j] + i], np.broadcast_to(cols, best[j].shape)), part)
            grads.append(g)
        grads += [back.sum(axis=0), hidden.T @ p + 1e-4 * weights[-2], p.sum(axis=0)]
        for w, g, m, v in zip(weights, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    *tables, bias, out, out_bias = [w.astype(np.float32).tobytes() for w in weights]
    return Network(languages, tuple(tables), bias, out, out_bias)


class Reader:
    """A network laid out for reading: rows of filter values per pair of bytes."""

    def __init__(self, net: Network):
        tables, self.bias, self.out, self.out_bias = arrays(net)
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(1 << 16, FILTERS)
        #: Per width: (first byte, what is looked up there) for pairs, then single bytes.
        self.pairs = [[(i, pair(t[i], t[i + 1])) for i in range(0, w - 1, 2)] for w, t in zip(WIDTHS, tables, strict=True)]
        self.single = [(w - 1, t[w - 1]) if w % 2 else None for w, t in zip(WIDTHS, tables, strict=True)]

    def chances(self, rows: np.ndarray) -> np.ndarray:
        """Language chances of each window."""
        two = rows[:, :-1].astype(np.int32) * 256 + rows[:, 1:]
        pooled = []
        for pairs, single in zip(self.pairs, self.single, strict=True):
            z = None
            for i, t in pairs:
                part = t.take(two[:, i : i + WINDOW], axis=0)
                z = part if z is None else np.add(z, part, out=z)
            if single:
                z += single[1].take(rows[:, single[0] : single[0] + WINDOW], axis=0)
            pooled.append(z.max(axis=1))
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
        return softmax(hidden @ self.out + self.out_bias)


@lru_cache(maxsize=1)
def reader(net: Network) -> Reader:
    return Reader(net)


def texts_to_chances(net: Network, texts: list[str]) -> Iterator[np.ndarray]:
    """Language chances of each text, from all its windows in chunks of bounded size."""
    r, k = reader(net), len(net.languages)
    waiting, owners, held, sums, weights = [], [], 0, {}, {}

    def flush() -> None:
        nonlocal held
        rows, who = np.concatenate(waiting), np.concatenate(owners)
        for at in range(0, len(rows), CHUNK):
            part, own = rows[at : at + CHUNK], who[at : at + CHUNK]
            weight = LETTERS[part[:, :WINDOW]].sum(axis=1) + 1e-3
            p = r.chances(part) * weight[:, None]
            ids, inverse = np.unique(own, return_inverse=True)
            total = np.zeros((len(ids), k))
            np.add.at(total, inverse, p)
            mass = np.bincount(inverse, weight)
            for i, t, m in zip(ids.tolist(), total, mass, strict=True):
                sums[i], weights[i] = sums.get(i, 0) + t, weights.get(i, 0) + m
        waiting.clear()
        owners.clear()
        held = 0

    for i, text in enumerate(texts):
        rows = windows(FOLD[np.frombuffer(text.encode(), dtype=np.uint8)])
        waiting.append(rows)
        owners.append(np.full(len(rows), i))
        held += len(rows)
        if held >= CHUNK:
            flush()
    if waiting:
        flush()
    for i in range(len(texts)):
        yield sums[i] / weights[i]


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: CRC-32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 3 == 1, F.lit(False))


def excerpt(text: Column) -> Column:
    """A short text as it is, of a long one PASSAGES passages from hashed places all over it."""
    places = F.length(text) - WINDOW + 1
    starts = [F.pmod(F.xxhash64(text, F.lit(i)), places).cast("int") + 1 for i in range(PASSAGES)]
    drawn = F.concat_ws(" ", *[F.substring(text, start, F.lit(WINDOW)) for start in starts])
    return F.when(F.length(text) <= PASSAGES * WINDOW, text).otherwise(drawn)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Network | None:
    """Train on at most SAMPLE_TEXTS * SHARES rows of each language, those of least hash in their share, of
    which at most PASSAGES passages are read. Rows without a language or a letter are passed over."""
    rows = labelled.select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(doc_id), F.lit("sample")).alias("draw"),
        F.col(doc_id).alias("id"),
    ).filter("lang IS NOT NULL AND text IS NOT NULL")
    lettered = rows.filter(F.col("text").rlike(r"\p{L}")).withColumn("text", excerpt(F.col("text")))
    least = Window.partitionBy("lang", F.pmod("draw", F.lit(SHARES))).orderBy("draw", "id", "text")
    sample = lettered.withColumn("n", F.row_number().over(least)).filter(F.col("n") <= SAMPLE_TEXTS)
    found = sorted((r["lang"], r["draw"], r["text"]) for r in sample.select("lang", "draw", "text").collect())
    return train([t for _, _, t in found], [x for x, _, _ in found])


def predict(docs: DataFrame, net: Network | None, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Append the predicted language and its chance, from the text alone.

    Null texts and those without a letter are ``und`` with score 0, as are all without a network. Every
    window of a text counts, however long it is. Columns of these names are replaced.
    """
    kept = without(docs, lang_pred, score)
    if net is None:
        return docs.select(*kept, F.lit(UNKNOWN).alias(lang_pred), F.lit(0.0).alias(score))

    @F.pandas_udf("lang_pred string, score double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            names, scores = [UNKNOWN] * len(part), np.zeros(len(part))
            known = [i for i, t in enumerate(part) if t and LETTER.search(t)]
            for i, p in zip(known, texts_to_chances(net, [part.iloc[i] for i in known]), strict=True):
                names[i], scores[i] = net.languages[int(p.argmax())], min(1.0, float(p.max()))
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    # a filter on the result is not to be answered by a second pass over the texts
    found = docs.withColumn("__lang", of.asNondeterministic()(F.col(text)))
    return found.select(*kept, F.col("__lang.lang_pred").alias(lang_pred), F.col("__lang.score").alias(score))
