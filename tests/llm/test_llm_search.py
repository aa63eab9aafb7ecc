"""Ranked search, centroid clustering and packing against brute-force versions, and on odd rows."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from martloom.llm import centroids, packing, ranked_search
from martloom.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, k=10):
    """The contract word by word: (item, rank, doc, score)."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_words = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for name, text in items:
        scores = []
        for doc, bag in bags:
            score = 0
            for t in terms(text):
                if t in bag:
                    m = 25 + 75 * bag.total() * n_docs // n_words
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(name, r, None if absent else d, -s) for r, (s, absent, d) in enumerate(sorted(scores)[:k], start=1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_ranked_search(spark):
    docs, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    want = ranked([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows_of(QUERIES["op11_ranked_search"](spark, SMALL)) == want


def test_ranked_search_in_shards_and_blocks(spark, monkeypatch):
    """Small shards, small blocks of queries and waves of one stratum change nothing."""
    docs, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = rows_of(ranked_search.ranked(docs, items, 3))
    monkeypatch.setattr(ranked_search, "BLOCK_PAIRS", 300)
    assert rows_of(ranked_search.ranked(docs, items, 3)) == whole
    batches = [b for b in docs.select("doc_id", "text").toArrow().to_batches()]
    monkeypatch.setattr(ranked_search, "SHARD_WORDS", 1)
    shards = list(ranked_search._shards(iter(batches * 3)))
    assert len(shards) > 1 and sum(s.column("docs")[0].as_py() for s in shards) == 3 * whole_documents(docs)


def whole_documents(docs):
    return sum(bool(terms(r.text)) for r in docs.select("text").collect())


def test_strata_end_early():
    """With short documents about the query before many long ones, most strata are never visited."""
    import pyarrow as pa

    texts = ["needle thread"] * 12 + ["needle " + " ".join(f"w{i}x{j}" for j in range(i)) for i in range(50, 400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    (row,) = ranked_search._shards(iter([batch]))
    shard = next(ranked_search._decoded(row))
    docs, words = row.column("docs")[0].as_py(), row.column("words")[0].as_py()
    one = ranked_search.Words(pa.array(["needle thread"]), ranked_search.ALPHANUMERIC).hash
    block = ranked_search.Block(np.sort(one), np.array([0, 2]), np.array([0, 1]), np.array([5, 5]))
    best, lists = ranked_search.Best(10), ranked_search.Lists(shard, block, docs, words)
    assert ranked_search.visit(lists, block.term, block.times, best) < lists.strata / 4
    assert best.id.tolist() == list(range(10))


def test_ranked_search_odd(spark):
    docs = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (4, " .. "), (None, "A, B"), (5, "Ünï b" * 4000), (6, "b"), (7, "a"), (0, "a b")]
    items = [(1, "a b a"), (1, "a b a"), (2, None), (3, "..."), (4, "zzz"), (None, "a"), (5, "ünï Ünï b")]
    table = spark.createDataFrame([(i, t, i, "x") for i, t in docs], "doc_id long, text string, item_id long, score string")
    queries = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, term long")
    want = ranked(docs, [(1, "a b a"), (5, "ünï Ünï b")], 4)
    assert rows_of(ranked_search.ranked(table, queries, 4)) == want and len(want) > 4
    for d, q in ((table.limit(0), queries), (table, queries.limit(0)), (table.where("doc_id between 2 and 4"), queries)):
        assert ranked_search.ranked(d, q).count() == 0
    named = spark.createDataFrame([("p", "a b a")], "item_id string, text string")
    assert [r.item_id for r in ranked_search.ranked(table, named, 2).collect()] == ["p", "p"]


def clustering(vectors, first, rounds):
    def nearest(v, centres):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres))

    centres = [list(v) for v in first]
    for _ in range(rounds):
        own = defaultdict(list)
        for v in vectors:
            own[nearest(v, centres)[1]].append(v)
        for n, vs in own.items():
            centres[n] = [math.floor(Fraction(sum(x), len(vs))) for x in zip(*vs, strict=True)]
    return [nearest(v, centres) for v in vectors], centres


def test_clustering(spark):
    """Against plain loops over few vectors with many ties, in three dimensions."""
    rng = np.random.default_rng(5)
    vectors = [(i, rng.integers(-3, 4, 3).tolist()) for i in range(120)] + [(7, [0, 0, 0]), (None, [1, 1, 1])]
    table = spark.createDataFrame(vectors, "vec_id long, v array<int>").repartition(5)
    order = table.orderBy(F.asc_nulls_last(F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)), "v").limit(9).collect()
    want, centres = clustering([tuple(v) for _, v in vectors], [r.v for r in order], 4)
    rows, got = centroids.clustered(table, 9, 4, 2)
    assert got.tolist() == centres
    inertia, total = Counter(), sum(d for d, _ in want)
    for d, n in want:
        inertia[n] += d
    assert rows_of(rows) == sorted(((i, n, d, inertia[n], total) for (i, _), (d, n) in zip(vectors, want, strict=True)), key=str)


@pytest.mark.parametrize("width", [1, 2, 64])
def test_threshold_walk_is_exact(width):
    rng = np.random.default_rng(width)
    for k in (1, 2, 40):
        c, x = rng.integers(-20, 21, (k, width)), rng.integers(-25, 26, (500, width))
        label, distance, taken = centroids.Lists(c).nearest(x)
        every = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        assert (label == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all() and (taken <= k).all()


def test_threshold_walk_ends_early():
    """Vectors beside their centroids need few exact distances."""
    rng = np.random.default_rng(1)
    c = rng.integers(-1000, 1000, (200, 4))
    label, _, taken = centroids.Lists(c).nearest(c[rng.integers(0, 200, 300)] + rng.integers(-3, 4, (300, 4)))
    assert taken.mean() < 20 and (taken < 200).all()


def test_clustering_odd(spark):
    ok = [0.5] * 64
    rows = [(1, ok), (2, None), (3, [None] + ok[1:]), (4, [float("nan")] + ok[1:]), (5, [float("inf")] + ok[1:]), (6, ok[:3]), (1, ok), (None, ok), (8, [-0.001] * 64)]
    table = spark.createDataFrame([(i, e, 0, i) for i, e in rows], "vec_id long, embedding array<float>, cluster int, distance long")
    kept = centroids.whole_numbers(table)
    assert sorted(kept.collect(), key=str) == sorted([(1, [128] * 64)] * 2 + [(None, [128] * 64), (8, [-1] * 64)], key=str)
    found, centres = centroids.clustered(kept, 40, 5)
    assert len(centres) == 4 and {r.distance for r in found.collect()} == {0} and found.count() == 4
    assert centroids.clustered(kept.limit(0))[0].count() == 0
    with pytest.raises(Exception, match="out of range"):
        centroids.whole_numbers(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<float>")).collect()


def packing_is_sound(rows, docs, capacity, tokenizer, end_id=1):
    """Every id in exactly one piece, pieces gapless in sequences; returns the lengths of the sequences."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for i, t in docs:
        want[i].append([*tokenizer.encode(t or "", add_special_tokens=False).ids, end_id])
    assert set(by_doc) == set(want)
    for i, (ids, *_) in want.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            part = ids[r.start : r.start + r.length]
            assert r.start == at and r.length == len(part) > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
            at += r.length
        assert at == len(ids)
    lengths = []
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
        lengths.append(at)
    return lengths


def test_packing(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(90_000, None), (90_001, ""), (None, "one  two\n"), (90_002, "word " * 30_000)]
    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    table = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string")
    for parts in (1, 7):
        got = packing.piece_table(table.repartition(parts), path("byte_bpe_50k.json")).collect()
        lengths = packing_is_sound(got, rows, 2048, tokenizer)
        assert all(n == 2048 or n & (n - 1) == 0 for n in lengths) and sum(n < 2048 for n in lengths) <= 11 * parts
    # Cuts: at whole windows of long documents, and at most one more for each window.
    assert len(got) <= len(rows) + 2 * len(lengths)
    twice = packing.packed(table.where("doc_id < 5").union(table.where("doc_id < 5")), path("byte_bpe_50k.json"), capacity=64)
    assert twice.agg(F.sum("length")).first()[0] == 2 * sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows if i is not None and i < 5)
    assert packing.packed(table.limit(0), path("byte_bpe_50k.json")).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.packed(table, path("byte_bpe_50k.json"), capacity=1000)


def test_differencing():
    """Nearly equal windows, as near as a greedy placement at least; their number rises until none is too full."""
    rng = np.random.default_rng(3)
    assert sorted(np.bincount(packing.differenced([8, 7, 6, 5, 4], 2), weights=[8, 7, 6, 5, 4])) == [14, 16]
    for n, m in ((200, 8), (60, 4)):
        sizes = rng.integers(1, 2000, n).tolist()
        sums = np.bincount(packing.differenced(sizes, m), weights=sizes, minlength=m)
        greedy = np.zeros(m)
        for s in sorted(sizes, reverse=True):
            greedy[greedy.argmin()] += s
        assert sums.sum() == sum(sizes) and np.ptp(sums) <= max(np.ptp(greedy), 40)
        place = packing.whole_windows(sizes, 2048)
        full = np.bincount(place, weights=sizes)
        assert full.max() <= 2048 and len(full) >= -(-sum(sizes) // 2048)
    assert len(set(packing.whole_windows([1500] * 3, 2048).tolist())) == 3
    with pytest.raises(ValueError, match="capacity"):
        packing.whole_windows([2049], 2048)
