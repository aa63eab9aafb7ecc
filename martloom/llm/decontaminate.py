"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of documents of bounded size in one task. Its words become symbols: benchmark words have their own,
all other words and the ends of documents share one, and runs of it are kept once, since no benchmark phrase crosses it.
Over the shard's Burrows-Wheeler transform lies a wavelet tree, level by level, with ranks by popcount. All phrases are
searched backwards at once, occurrences are located by walking to sampled suffix positions, and the spans are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.ngram_join import slices
from martloom.llm.shared import release, written
from martloom.llm.text_arrays import ALPHANUMERIC, Words

WINDOW = 13
SHARD_BYTES = 2 << 20
#: (window, item) pairs that go to the executors at once, some 120 bytes each; more take one pass over the shards for each part.
PART_PAIRS = 1 << 17
SAMPLED = 8
END, OTHER = 0, 1


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))
        self.ones = int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class WaveletTree:
    """Ranks and symbols of a sequence; each level's nodes lie side by side, zeros of all nodes before ones."""

    def __init__(self, symbols: np.ndarray, most: int) -> None:
        self.depth = max(1, int(most).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for level in reversed(range(self.depth)):
            ones = (symbols >> level & 1).astype(bool)
            bits = Bits(ones)
            self.levels.append((bits, len(symbols) - bits.ones))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, (bits, zeros) in zip(reversed(range(self.depth)), self.levels, strict=True):
            ones = bits.rank(i)
            i = np.where(symbol >> level & 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self._down(symbol, i) - self._down(symbol, np.zeros_like(i))

    def get(self, i: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(i)
        for bits, zeros in self.levels:
            one, ones = bits.get(i), bits.rank(i)
            symbol = symbol << 1 | one
            i = np.where(one, zeros + ones, i - ones)
        return symbol


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order. Prefixes of doubling length are ranked; only tied ones are sorted again."""
    n, bits = len(text), max(1, int(text.max()).bit_length())
    length = max(1, 63 // bits)
    padded = np.concatenate((text, np.zeros(length, dtype=np.int64)))
    key = np.zeros(n, dtype=np.int64)
    for j in range(length):
        key = key << bits | padded[j : j + n]
    order = np.argsort(key)
    new = np.concatenate(([True], key[order[1:]] != key[order[:-1]]))
    rank = np.empty(n, dtype=np.int64)
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = group
    last = np.concatenate((new[1:], [True]))
    tied = np.flatnonzero(~(new & last))
    while len(tied):
        who = order[tied]
        after = who + length
        then = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.lexsort((then, rank[who]))
        who, then = who[by], then[by]
        own = rank[who]
        order[tied] = who
        new = np.concatenate(([True], (own[1:] != own[:-1]) | (then[1:] != then[:-1])))
        rank[who] = np.maximum.accumulate(np.where(new, tied, 0))
        last = np.concatenate((new[1:], [True]))
        tied = tied[~(new & last)]
        length *= 2
    return order


class FmIndex:
    def __init__(self, text: np.ndarray) -> None:
        """`text` ends with the one END in it."""
        order = suffix_array(text)
        most = int(text.max())
        self.size = len(text)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=most + 1))))
        self.tree = WaveletTree(text[order - 1], most)
        chosen = order % SAMPLED == 0
        self.marked, self.places = Bits(chosen), order[chosen]
        self.most = most

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of all phrases (right-aligned, one a line), found from their last word to the first."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for step in range(phrases.shape[1]):
            symbol = phrases[:, -1 - step]
            live = np.flatnonzero((step < lengths) & (low < high))
            absent = symbol[live] > self.most
            high[live[absent]] = low[live[absent]]
            live = live[~absent]
            s = symbol[live]
            low[live] = self.first[s] + self.tree.rank(s, low[live])
            high[live] = self.first[s] + self.tree.rank(s, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: steps back until a sampled position, plus the steps."""
        place, steps, live, row = np.empty(len(rows), np.int64), 0, np.arange(len(rows)), rows
        while len(live):
            there = self.marked.get(row)
            place[live[there]] = self.places[self.marked.rank(row[there])] + steps
            live, row = live[~there], row[~there]
            symbol = self.tree.get(row)
            row = self.first[symbol] + self.tree.rank(symbol, row)
            steps += 1
        return place


@dataclass
class Phrases:
    """Distinct windows of a part of the benchmark, as symbols, and which items have each."""

    known: np.ndarray
    windows: np.ndarray
    lengths: np.ndarray
    names: pa.Array
    item: np.ndarray
    window_of: np.ndarray

    @staticmethod
    def of(pairs: pa.Table, window: int) -> Phrases:
        """From (words, item_id): a window's word hashes as bytes, and an item that has it."""
        distinct = pairs["words"].combine_chunks().dictionary_encode()
        names = pairs["item_id"].combine_chunks().dictionary_encode()
        rows = [np.frombuffer(w, dtype=np.uint64) for w in distinct.dictionary.to_pylist()]
        lengths = np.array([len(r) for r in rows], dtype=np.int64)
        known = np.unique(np.concatenate(rows)) if rows else np.empty(0, np.uint64)
        windows = np.zeros((len(rows), window), dtype=np.int64)
        for at, r in enumerate(rows):
            windows[at, window - len(r) :] = np.searchsorted(known, r) + OTHER + 1
        return Phrases(known, windows, lengths, names.dictionary, np.asarray(names.indices, dtype=np.int64), np.asarray(distinct.indices, dtype=np.int64))


def windows_of(benchmark: DataFrame, window: int) -> DataFrame:
    """(words, item_id): every distinct window of every item, as the bytes of its words' hashes."""
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"), ALPHANUMERIC)
                n = words.counts()
                width = np.minimum(n, window)
                count = np.where(n > 0, n - width + 1, 0)
                owner = np.repeat(np.arange(len(n)), count)
                start = words.first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                found = [words.hash[a:b].tobytes() for a, b in zip(start.tolist(), (start + width[owner]).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), part.column("item_id").take(pa.array(owner))], ["words", "item_id"])

    schema = T.StructType([T.StructField("words", T.BinaryType()), rows.schema["item_id"]])
    return rows.mapInArrow(cut, schema).distinct()


def _found(texts: pa.Array, phrases: Phrases) -> tuple[list, list, list, np.ndarray]:
    """Per text: starts and ends of merged hit spans (word numbers), items found, number of words."""
    words = Words(texts, ALPHANUMERIC)
    n, docs = words.counts(), len(texts)
    spans: list[tuple[list, list]] = [([], []) for _ in range(docs)]
    items: list = [[] for _ in range(docs)]
    if not len(words.hash) or not len(phrases.windows):
        return [s for s, _ in spans], [e for _, e in spans], items, n
    at = np.minimum(np.searchsorted(phrases.known, words.hash), len(phrases.known) - 1)
    symbol = np.where(phrases.known[at] == words.hash, at + OTHER + 1, OTHER)
    doc = np.repeat(np.arange(docs), n)
    use = symbol != OTHER
    gap = np.ones(len(symbol), dtype=bool)
    gap[1:] = ~use[:-1] | (doc[1:] != doc[:-1])
    place = np.flatnonzero(use)
    text = np.empty(len(place) + int(gap[place].sum()) + 1, dtype=np.int64)
    origin = np.full(len(text), -1, dtype=np.int64)
    to = np.arange(len(place)) + np.cumsum(gap[place])
    text[:] = OTHER
    text[to], origin[to], text[-1] = symbol[place], place, END
    index = FmIndex(text)
    low, high = index.search(phrases.windows, phrases.lengths)
    times = high - low
    if not times.any():
        return [s for s, _ in spans], [e for _, e in spans], items, n
    hit = np.flatnonzero(times)
    rows = np.repeat(low[hit] - np.concatenate(([0], np.cumsum(times[hit])[:-1])), times[hit]) + np.arange(times[hit].sum())
    which = np.repeat(hit, times[hit])
    start = origin[index.locate(rows)]
    end = start + phrases.lengths[which]
    order = np.lexsort((end, start))
    s, e = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], (s[1:] > e[:-1]) | (doc[s[1:]] != doc[s[:-1]])))
    s, e = s[new], e[np.concatenate((new[1:], [True]))]
    for a, b, d in zip((s - words.first[doc[s]]).tolist(), (e - words.first[doc[s]]).tolist(), doc[s].tolist(), strict=True):
        spans[d][0].append(a)
        spans[d][1].append(b)
    pairs = np.unique(np.stack((doc[start], which)), axis=1)
    order = np.argsort(phrases.window_of, kind="stable")
    sorted_windows = phrases.window_of[order]
    a, b = np.searchsorted(sorted_windows, pairs[1], "left"), np.searchsorted(sorted_windows, pairs[1], "right")
    for d, x, y in zip(pairs[0].tolist(), a.tolist(), b.tolist(), strict=True):
        items[d] += phrases.item[order[x:y]].tolist()
    names = [phrases.names.take(pa.array(sorted(set(x)), pa.int64())).to_pylist() for x in items]
    return [s for s, _ in spans], [e for _, e in spans], [sorted(x) for x in names], n


def _merge(spans: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_MADE = ("n_words", "hit_from", "hit_to", "items")


def _pass(rows: DataFrame, text: Column, phrases: Phrases, name: str, earlier: bool) -> DataFrame:
    """One part of the benchmark against all shards: spans and items in the column `_found`, with those of earlier parts."""
    shared = rows.sparkSession.sparkContext.broadcast(phrases)

    def shard(part: pa.RecordBatch) -> pa.Array:
        begin, end, items, n = _found(part.column("text"), shared.value)
        if earlier:
            for i, was in enumerate(part.column("was").to_pylist()):
                both = _merge([*zip(was["hit_from"], was["hit_to"], strict=True), *zip(begin[i], end[i], strict=True)])
                begin[i], end[i], items[i] = [x for x, _ in both], [y for _, y in both], sorted({*was["items"], *items[i]})
        spans = pa.list_(pa.int32())
        made = [pa.array(n.astype(np.int64)), pa.array(begin, spans), pa.array(end, spans), pa.array(items, pa.list_(shared.value.names.type))]
        return pa.StructArray.from_arrays(made, list(_MADE))

    @F.arrow_udf(f"n_words long, hit_from array<int>, hit_to array<int>, items array<{name}>")
    def searched(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for arrays in batches:
            batch = pa.RecordBatch.from_arrays(list(arrays), ["text", "was"])
            yield pa.concat_arrays([shard(p) for p in slices(batch, "text", SHARD_BYTES)] or [shard(batch)])
        release()

    return rows.withColumn("_found", searched(text, F.col("_found") if earlier else F.lit(0)))


def _contaminated(rows: DataFrame, text: Column, benchmark: DataFrame, window: int) -> DataFrame:
    """`rows` with the struct `_found`. Distinct windows are made by Spark; a part of them at a time is collected and broadcast,
    and the rows are written between parts."""
    pairs = written(windows_of(benchmark, window), "windows")
    parts, name = max(1, -(-pairs.count() // PART_PAIRS)), pairs.schema["item_id"].dataType.simpleString()
    for part in range(parts):
        some = pairs.where(F.pmod(F.xxhash64("words"), F.lit(parts)) == part).toArrow()
        rows = _pass(rows, text, Phrases.of(some, window), name, part > 0)
        if part + 1 < parts:
            rows = written(rows, "searched")
    return rows


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Columns of `docs` and, per row: n_words, merged hit spans `hit_from`, `hit_to` (word numbers, end exclusive), and
    `items`, the sorted ids of benchmark items with a window in the text.

    Words are runs of a-z, 0-9 and non-ASCII characters after A-Z are lower-cased, compared by 64-bit hashes. A benchmark text
    gives its windows of `window` words, or itself as one if it is shorter; null texts, null ids and texts without words give
    none. A null or empty text has no words and no hits. Repeated rows are judged each on its own. Columns of `docs` named as
    the made ones are replaced. Empty tables of either side are fine.
    """
    rows = docs.drop(*_MADE).withColumn("text", F.col("text").cast("string"))
    found = _contaminated(rows, F.col("text"), benchmark, window)
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], "_found.*")


def judged(rows: DataFrame, hundredths: int = 5) -> DataFrame:
    """With n_hit, n_items, and whether at least `hundredths` of the words are hit."""
    hit = F.coalesce(F.expr("aggregate(zip_with(hit_from, hit_to, (a, b) -> cast(b - a as long)), 0L, (s, x) -> s + x)"), F.lit(0))
    rows = rows.withColumn("n_hit", hit).withColumn("n_items", F.size("items").cast("long"))
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= hundredths * F.col("n_words")))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, hundredths: int = 5) -> DataFrame:
    """Rows of `docs`, its columns, that are not contaminated."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    found = _contaminated(rows, F.col("_row.text").cast("string"), benchmark, window).select("_row", "_found.*")
    return judged(found, hundredths).where("not contaminated").select("_row.*")
