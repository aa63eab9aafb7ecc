"""Ranked lexical search over a length-stratified index.

A shard of the index is a run of documents in one task. Its documents are ordered by their number of terms, and each
term's postings by that number and then by tf, so documents of one normaliser m, a stratum, lie together in every list and
equal tf in a stratum are a run whose impact is computed once. For a query, a stratum's bound is the sum of its terms'
greatest impacts there. Strata are visited from the highest bound down, and the search of a shard ends when the next bound
is below the k-th best score that its task has found so far. The best of every task are merged per query.

The index holds all terms and does not depend on the queries; they come in blocks of bounded size, each a pass over it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.ngram_join import slices
from martloom.llm.shared import written
from martloom.llm.text_arrays import ALPHANUMERIC, Words

#: Words and documents of a shard, and (item, term) pairs that go to the executors at once, 24 bytes each.
SHARD_WORDS, SHARD_DOCS, BLOCK_PAIRS = 2 << 20, 1 << 18, 1 << 19
#: Normaliser: 100 for a document of average length, of which this part follows the length.
SLOPE = 75
#: Strata of the first wave of a query; every further wave has twice as many.
FIRST_WAVE = 8

_SHARD = "docs long, words long, ids binary, named binary, lengths binary, terms binary, df binary, doc binary, tf binary"
_KINDS = {"ids": np.int64, "named": np.bool_, "lengths": np.int64, "terms": np.uint64, "df": np.int64, "doc": np.int32, "tf": np.int32}
_EXACT = 1 << 53


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges, one range after the other."""
    size = end - start
    return np.repeat(start - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum()) if len(size) else np.empty(0, np.int64)


def _shard(ids: np.ndarray, named: np.ndarray, lengths: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
    """One row of the index: documents by length, the sorted terms, and their postings by (term, length, tf down)."""
    by_length = np.argsort(lengths, kind="stable")
    place = np.empty(len(ids), dtype=np.int64)
    place[by_length] = np.arange(len(ids))
    terms, code = np.unique(words, return_inverse=True)
    key = np.sort(code.astype(np.int64) * max(len(ids), 1) + np.repeat(place, lengths))
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    tf = np.diff(np.append(first, len(key)))
    term, doc = np.divmod(key[first], max(len(ids), 1))
    ordered = lengths[by_length]
    length = np.unique(ordered, return_inverse=True)[1]
    most = int(tf.max(initial=0)) + 1
    if len(terms) * (int(length.max(initial=0)) + 1) * most < 1 << 62:
        order = np.argsort((term * (int(length.max(initial=0)) + 1) + length[doc]) * most - tf, kind="stable")
    else:
        order = np.lexsort((-tf, length[doc], term))
    columns = {
        "ids": ids[by_length], "named": named[by_length], "lengths": ordered, "terms": terms,
        "df": np.bincount(term, minlength=len(terms)), "doc": doc[order], "tf": tf[order],
    }
    totals = [pa.array([int((lengths > 0).sum())]), pa.array([int(lengths.sum())])]
    return pa.RecordBatch.from_arrays([*totals, *[pa.array([columns[c].astype(k).tobytes()], pa.binary()) for c, k in _KINDS.items()]], ["docs", "words", *_KINDS])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    words = docs = 0
    for batch in batches:
        for part in slices(batch, "text"):
            found = Words(part.column("text"), ALPHANUMERIC)
            name = part.column("doc_id")
            held.append((np.asarray(name.fill_null(0), dtype=np.int64), name.is_valid().to_numpy(zero_copy_only=False), found.counts(), found.hash))
            words, docs = words + len(found.hash), docs + part.num_rows
            if words >= SHARD_WORDS or docs >= SHARD_DOCS:
                yield _shard(*map(np.concatenate, zip(*held, strict=True)))
                held, words, docs = [], 0, 0
    if held:
        yield _shard(*map(np.concatenate, zip(*held, strict=True)))


def index(docs: DataFrame) -> DataFrame:
    """The written index of `docs` (doc_id, text), a row per shard. Texts are read once and never shuffled."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(rows.mapInArrow(_shards, _SHARD), "lexical-index")


def normalisers(lengths: np.ndarray, docs: int, words: int) -> np.ndarray:
    """m of each length: 100 at the average length."""
    some, which = np.unique(lengths, return_inverse=True)
    return np.array([100 - SLOPE + SLOPE * int(n) * docs // words for n in some], dtype=np.int64)[which]


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


@dataclass
class Block:
    """Queries of one pass: their distinct terms, and per query its terms with occurrences times weight."""

    terms: np.ndarray
    first: np.ndarray
    term: np.ndarray
    times: np.ndarray


class Lists:
    """The lists of a shard for the terms of a block, cut into segments (term, stratum)."""

    def __init__(self, shard: dict[str, np.ndarray], block: Block, docs: int, words: int) -> None:
        self.ids, self.named = shard["ids"], shard["named"]
        m = normalisers(shard["lengths"], docs, words)
        strata, self.stratum = np.unique(m, return_inverse=True)
        self.strata = len(strata)
        at = np.minimum(np.searchsorted(shard["terms"], block.terms), max(len(shard["terms"]) - 1, 0))
        here = np.flatnonzero(shard["terms"][at] == block.terms) if len(shard["terms"]) else np.empty(0, np.int64)
        end = np.cumsum(shard["df"])
        start = end - shard["df"]
        post = _ranges(start[at[here]], end[at[here]])
        term = np.repeat(here, shard["df"][at[here]])
        self.doc, tf = shard["doc"][post], shard["tf"][post].astype(np.int64)
        where = self.stratum[self.doc]
        new_segment = np.ones(len(post), dtype=bool)
        new_segment[1:] = (term[1:] != term[:-1]) | (where[1:] != where[:-1])
        new_run = new_segment.copy()
        new_run[1:] |= tf[1:] != tf[:-1]
        run = np.flatnonzero(new_run)
        run_impact = impact(tf[run], strata[where[run]])
        self.impact = np.repeat(run_impact, np.diff(np.append(run, len(post))))
        self.start = np.flatnonzero(new_segment)
        self.end = np.append(self.start[1:], len(post))
        self.where = where[self.start]
        self.most = np.maximum.reduceat(run_impact, np.searchsorted(run, self.start)) if len(run) else np.empty(0, np.int64)
        self.first = np.searchsorted(term[self.start], np.arange(len(block.terms) + 1))


class Best:
    """The k best of a query so far: higher scores first, equal ones by id, documents without id last."""

    def __init__(self, k: int) -> None:
        self.k, self.least = k, 1
        self.score, self.id, self.named = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, named: np.ndarray) -> None:
        if len(score) > 4 * self.k:
            worth = score >= np.partition(score, -self.k)[-self.k]
            score, ids, named = score[worth], ids[worth], named[worth]
        score, ids, named = np.concatenate((self.score, score)), np.concatenate((self.id, ids)), np.concatenate((self.named, named))
        order = np.lexsort((ids, ~named, -score))[: self.k]
        self.score, self.id, self.named = score[order], ids[order], named[order]
        if len(order) == self.k:
            self.least = int(self.score[-1])


def _sums(doc: np.ndarray, gain: np.ndarray, size: int, most: int) -> np.ndarray:
    """Gains added up per document; in doubles as long as these hold every whole number that can come up."""
    if most < _EXACT:
        return np.bincount(doc, weights=gain, minlength=size).astype(np.int64)
    out = np.zeros(size, dtype=np.int64)
    np.add.at(out, doc, gain)
    return out


def visit(lists: Lists, term: np.ndarray, times: np.ndarray, best: Best) -> int:
    """Add a query's best documents of a shard to `best`; returns the number of strata visited."""
    segment = _ranges(lists.first[term], lists.first[term + 1])
    if not len(segment):
        return 0
    times = np.repeat(times, lists.first[term + 1] - lists.first[term])
    where = lists.where[segment]
    bound = np.zeros(lists.strata, dtype=np.int64)
    np.add.at(bound, where, times * lists.most[segment])
    order = np.argsort(-bound, kind="stable")
    seen, wave = 0, FIRST_WAVE
    while seen < len(order) and bound[order[seen]] >= best.least:
        chosen = order[seen : seen + wave]
        chosen = chosen[bound[chosen] >= best.least]
        inside = np.zeros(lists.strata, dtype=bool)
        inside[chosen] = True
        use = inside[where]
        start, end = lists.start[segment[use]], lists.end[segment[use]]
        post = _ranges(start, end)
        score = _sums(lists.doc[post], np.repeat(times[use], end - start) * lists.impact[post], len(lists.ids), int(bound[order[seen]]))
        found = np.flatnonzero(score >= best.least)
        best.add(score[found], lists.ids[found], lists.named[found])
        seen, wave = seen + len(chosen), 2 * wave
    return seen


def _decoded(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
    for i in range(batch.num_rows):
        yield {c: np.frombuffer(batch.column(c)[i].as_buffer(), dtype=k) for c, k in _KINDS.items() if c in batch.schema.names}


def _document_counts(shards: DataFrame, block: np.ndarray) -> DataFrame:
    """(term, df) of the block's terms that occur; a task sends each term once."""
    shared = shards.sparkSession.sparkContext.broadcast(block)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, df = shared.value, np.zeros(len(shared.value), dtype=np.int64)
        for batch in batches:
            for shard in _decoded(batch):
                at = np.searchsorted(shard["terms"], terms)
                there = at < len(shard["terms"])
                there[there] = shard["terms"][at[there]] == terms[there]
                df[there] += shard["df"][at[there]]
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(terms[some].view(np.int64)), pa.array(df[some])], ["term", "df"])

    return shards.select("terms", "df").mapInArrow(counted, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times): occurrences of each term in an item; rows of one item_id are one item, equal rows one row."""
    kind = items.schema["item_id"].dataType

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"), ALPHANUMERIC)
                owner = np.repeat(np.arange(part.num_rows), words.counts())
                yield pa.RecordBatch.from_arrays([part.column("item_id").take(pa.array(owner)), pa.array(words.hash.view(np.int64))], ["item_id", "term"])

    rows = items.select("item_id", F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null").dropDuplicates()
    schema = T.StructType([T.StructField("item_id", kind), T.StructField("term", T.LongType())])
    return rows.mapInArrow(counted, schema).groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times"))


def _searched(shards: DataFrame, block: Block, names: pa.Array, docs: int, words: int, k: int, schema: T.StructType) -> DataFrame:
    """The k best of every task for every query of the block."""
    shared = shards.sparkSession.sparkContext.broadcast(block)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        best = [Best(k) for _ in range(len(block.first) - 1)]
        for batch in batches:
            for shard in _decoded(batch):
                lists = Lists(shard, block, docs, words)
                for q, b in enumerate(best):
                    a, z = block.first[q], block.first[q + 1]
                    visit(lists, block.term[a:z], block.times[a:z], b)
        who = np.repeat(np.arange(len(best)), [len(b.score) for b in best])
        ids = pa.array(np.concatenate([b.id for b in best]), mask=~np.concatenate([b.named for b in best]))
        yield pa.RecordBatch.from_arrays([names.take(pa.array(who)), ids, pa.array(np.concatenate([b.score for b in best]))], ["item_id", "doc_id", "score"])

    return shards.select(*_KINDS).mapInArrow(search, schema)


def _block(pairs: pa.Table) -> tuple[Block, pa.Array]:
    terms, term = np.unique(np.asarray(pairs["term"].combine_chunks()).view(np.uint64), return_inverse=True)
    names = pairs["item_id"].combine_chunks().dictionary_encode()
    owner = np.asarray(names.indices)
    order = np.argsort(owner, kind="stable")
    times = np.asarray(pairs["gain"].combine_chunks())[order]
    return Block(terms, np.searchsorted(owner[order], np.arange(len(names.dictionary) + 1)), term[order], times), names.dictionary


def search(shards: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents of the index with a score above 0.

    Terms are runs of a-z, 0-9 and non-ASCII characters after A-Z are lower-cased, compared by 64-bit hashes. Equal scores
    rank by doc_id, documents without one last. Items that are null, empty or without a known term have no rows, as have
    those without item_id; equal rows of `items` count once, other rows of one item_id are taken together. Every row of
    the documents is a document of its own; null and empty texts are none. Fewer than k matches: all of them.
    """
    spark = shards.sparkSession
    schema = T.StructType([T.StructField("item_id", items.schema["item_id"].dataType), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    totals = shards.agg(F.sum("docs"), F.sum("words")).first()
    docs, words = totals[0] or 0, totals[1] or 0
    pairs = written(item_terms(items), "item-terms")
    blocks = -(-pairs.count() // BLOCK_PAIRS)
    found = []
    for b in range(blocks if words else 0):
        some = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        vocabulary = np.sort(np.asarray(some.select("term").distinct().toArrow()["term"].combine_chunks()).view(np.uint64))
        weight = F.floor(1000 * F.log(F.lit(float(2 * docs + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
        weighed = some.join(_document_counts(shards, vocabulary), "term").select("item_id", "term", (F.col("times") * weight).alias("gain"))
        block, names = _block(weighed.toArrow())
        if len(block.term):
            found.append(_searched(shards, block, names, docs, words, k, schema))
    every = spark.createDataFrame([], schema) if not found else found[0]
    for more in found[1:]:
        every = every.union(more)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Index `docs` and search it for `items`; other columns of both are ignored."""
    return search(index(docs), items, k)
