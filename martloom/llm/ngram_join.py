"""Near-duplicate join on word n-grams by vertical partitioning (after Rong et al., "Fast and scalable distributed set
similarity joins for big data analytics").

The global n-gram order is cut into fragments twice. The first cut, by hash, sends every document's n-grams to the
fragments that count in how many different sets an n-gram occurs. N-grams of one set only can be shared by nobody: they
stay behind as a number, and documents with too many of them can have no partner and go no further. The rest are
put in the global order, rare first, and cut a second time, by frequency band: a candidate pair's overlap is counted in
each band on its own and summed per pair.

Links are not listed pair by pair within groups of copies. Equal sets are one class. Classes meet at the n-grams of
their prefixes; at each, all are first compared with one of them, and what is linked is one component from then on. Only
classes of different components are then compared with one another, after length and bitmap bounds, so every link
between different components is found and none inside a component is needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.components import contracted
from martloom.llm.shared import partitions, release, written
from martloom.llm.text_arrays import NOT_SPACE, Words, shingle_sets

#: Text bytes turned into arrays at a time, and n-grams sent on in one row for all fragments.
SLICE_BYTES = 2 << 20
SEND_GRAMS = 1 << 20
#: 64-bit words of a class's bitmap.
BITMAP_WORDS = 8
#: Further rounds of comparing with one class of each n-gram, as long as a round still joins this part of the rest.
WORTHWHILE = 0.01

#: Text bytes whose n-grams one fragment holds, and rows of an n-gram's list that are compared as one block.
FRAGMENT_BYTES = 6 << 20
BLOCK_ROWS = 2048
#: Documents kept, 24 bytes each, whose list goes to all tasks; a longer one is joined by shuffling the documents.
BROADCAST_ROWS = 1 << 20

# A class is named by the digest `k` of its set and the set's size n. Of a row's classes, `opens` tells at which n-grams each begins.
_GRAMS = "k binary, n binary, opens binary, grams binary"
_DOCUMENTS = "m_id binary, m_text binary, m_k binary, m_n binary"
_SENT = f"fragment int, {_GRAMS}, {_DOCUMENTS}"
_COUNTED = f"bucket int, {_GRAMS}, seen binary, {_DOCUMENTS}"
_CLASS = f"k long, n long, own long, grams array<long>, seen array<int>, {', '.join(f'b{i} long' for i in range(BITMAP_WORDS))}"


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about `most` bytes of text, one row at least."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
        yield batch.slice(a, b - a)
        a = b


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The bytes of all rows of a binary column, one after the other, as numbers."""
    parts = [np.empty(0, np.uint8)]
    for chunk in column.chunks:
        _, offsets, data = chunk.buffers()
        if data is not None and len(chunk):
            at = np.frombuffer(offsets, dtype=np.int32)
            parts.append(np.frombuffer(data, dtype=np.uint8)[at[chunk.offset] : at[chunk.offset + len(chunk)]])
    return np.concatenate(parts).view(kind)


def _cells(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(k, n, sizes, grams) of all cells: a class and its n-grams there, which follow one another."""
    grams = _joined(table["grams"], np.uint64)
    begin = np.flatnonzero(_joined(table["opens"], np.uint8))
    return _joined(table["k"], np.int64), _joined(table["n"], np.int32), np.diff(np.append(begin, len(grams))), grams


def _cell_row(k: np.ndarray, n: np.ndarray, sizes: np.ndarray, grams: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    opens = np.zeros(len(grams), dtype=np.uint8)
    opens[np.cumsum(sizes) - sizes] = 1
    return k.tobytes(), n.tobytes(), opens.tobytes(), grams.tobytes()


def _batch(rows: list[tuple], fields: str) -> pa.RecordBatch:
    schema = pa.schema([(f.split()[0], pa.int32() if f.endswith("int") else pa.binary()) for f in fields.split(", ")])
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)


def _sent(batches: Iterator[pa.RecordBatch], size: int, fragments: int) -> Iterator[pa.RecordBatch]:
    """Texts to rows of whole arrays, one for each fragment: classes and the n-grams each has there; and one of the documents,
    dealt to the fragments in turn."""
    turn = TaskContext.get().partitionId() * 7919 if TaskContext.get() else 0

    def flush(ids: np.ndarray, texts: np.ndarray, sets: list) -> pa.RecordBatch:
        k = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=8).digest() for s in sets), dtype="<i8")
        n = np.array([len(s) for s in sets], dtype=np.int32)
        classes, first = {}, []
        for i, name in enumerate(zip(k.tolist(), n.tolist(), strict=True)):
            if n[i] and classes.setdefault(name, i) == i:
                first.append(i)
        first = np.array(first, dtype=np.int64)
        grams = np.concatenate([sets[i] for i in first]) if len(first) else np.empty(0, np.uint64)
        doc = np.repeat(np.arange(len(first)), n[first])
        fragment = ((grams >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(fragment.astype(np.uint16 if fragments < 1 << 16 else np.int64), kind="stable")
        grams, cell = grams[order], (fragment * max(len(first), 1) + doc)[order]
        cells, counts = np.unique(cell, return_counts=True)
        at, ends = cells // max(len(first), 1), np.concatenate(([0], np.cumsum(counts)))
        bounds = np.searchsorted(at, np.arange(fragments + 1))
        rows = [(turn % fragments, *[None] * 4, ids.tobytes(), texts.tobytes(), k.tobytes(), n.tobytes())]
        for f in np.flatnonzero(np.diff(bounds)):
            a, b = bounds[f], bounds[f + 1]
            who = first[cells[a:b] % len(first)]
            rows.append((int(f), *_cell_row(k[who], n[who], counts[a:b], grams[ends[a] : ends[b]]), *[None] * 4))
        return _batch(rows, _SENT)

    ids, texts, sets, held = [], [], [], 0
    for batch in batches:
        for part in slices(batch, "text"):
            new = shingle_sets(Words(part.column("text"), NOT_SPACE), size)
            ids.append(np.asarray(part.column("doc_id"), dtype=np.int64))
            texts.append(np.asarray(part.column("text_hash"), dtype=np.int64))
            sets += new
            held += sum(map(len, new))
            if held >= SEND_GRAMS or len(sets) >= 1 << 16:
                yield flush(np.concatenate(ids), np.concatenate(texts), sets)
                ids, texts, sets, held, turn = [], [], [], 0, turn + 1
    if sets:
        yield flush(np.concatenate(ids), np.concatenate(texts), sets)
        ids, texts, sets = [], [], []
    release()


def _counted(table: pa.Table, buckets: int) -> pa.Table:
    """One fragment: in how many classes each n-gram occurs; those of two or more go on, dealt by class."""
    k, n, sizes, grams = _cells(table)
    order = np.lexsort((n, k))
    again = (k[order][1:] == k[order][:-1]) & (n[order][1:] == n[order][:-1])
    owner = np.repeat(np.arange(len(k), dtype=np.int32), sizes)
    if again.any():
        chosen = np.ones(len(k), dtype=bool)
        chosen[order[1:][again]] = False
        grams, owner = grams[chosen[owner]], owner[chosen[owner]]
    order = np.argsort(grams)
    grams, owner = grams[order], owner[order]
    del order, again
    starts = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))) if len(grams) else np.empty(0, np.int64)
    times = np.diff(np.append(starts, len(grams))).astype(np.int32)
    seen = np.repeat(times, times)
    shared = seen > 1
    grams, owner, seen = grams[shared], owner[shared], seen[shared]
    bucket = (k.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((owner, bucket[owner]))
    grams, owner, seen = grams[order], owner[order], seen[order]
    rows = [(None,) * 6 + tuple(_joined(table[c], np.uint8).tobytes() for c in ("m_id", "m_text", "m_k", "m_n"))]
    at = bucket[owner]
    bounds = np.searchsorted(at, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(bounds)):
        s = slice(bounds[b], bounds[b + 1])
        who, counts = np.unique(owner[s], return_counts=True)
        rows.append((int(b), *_cell_row(k[who], n[who], counts, grams[s]), seen[s].tobytes(), *[None] * 4))
    return pa.Table.from_batches([_batch(rows, _COUNTED)])


def _gathered(table: pa.Table, percent: int) -> pa.Table:
    """One bucket of classes: each that may have a partner, with its shared n-grams in the global order."""
    k, n, sizes, grams = _cells(table)
    seen = _joined(table["seen"], np.int32)
    keys = np.empty(len(k), dtype=[("k", np.int64), ("n", np.int32)])
    keys["k"], keys["n"] = k, n
    found, first, which = np.unique(keys, return_index=True, return_inverse=True)
    shared = np.bincount(which, weights=sizes, minlength=len(found)).astype(np.int64)
    able = 100 * shared >= percent * n[first].astype(np.int64)
    owner = np.repeat(which, sizes)
    kept = able[owner]
    grams, seen, owner = grams[kept], seen[kept], owner[kept]
    order = np.lexsort((grams, seen, owner))
    grams, seen, owner = grams[order], seen[order], owner[order]
    classes = np.flatnonzero(able)
    bounds = np.searchsorted(owner, np.append(classes, len(found)))
    maps = np.zeros((len(classes), BITMAP_WORDS), dtype=np.uint64)
    bit = (grams % np.uint64(64 * BITMAP_WORDS)).astype(np.int64)
    row = np.searchsorted(classes, owner)
    np.bitwise_xor.at(maps, (row, bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64))
    lists = pa.array(bounds.astype(np.int32))
    whole = {"k": k[first], "n": n[first], "own": n[first] - shared}
    columns = {c: x[classes].astype(np.int64) for c, x in whole.items()} | {"grams": pa.ListArray.from_arrays(lists, pa.array(grams.view(np.int64))), "seen": pa.ListArray.from_arrays(lists, pa.array(seen))}
    columns |= {f"b{i}": maps[:, i].view(np.int64) for i in range(BITMAP_WORDS)}
    return pa.table({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kinds = {"m_id": np.int64, "m_text": np.int64, "m_k": np.int64, "m_n": np.int32}
        at = [_joined(pa.chunked_array([batch.column(c)]), k).astype(np.int64) for c, k in kinds.items()]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in at], ["doc_id", "text_hash", "k", "n"])


def sets_by_class(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(members: doc_id, text_hash, k, n) of every row, and (classes) that may have a partner. Both written.

    Fragments and buckets follow the size of the texts, so that what one holds is bounded at any number of partitions.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(partitions(docs.sparkSession), -(-total // FRAGMENT_BYTES))
    sent = docs.mapInArrow(partial(_sent, size=size, fragments=parts), _SENT).repartition(parts, "fragment")

    def counted_in(table: pa.Table) -> pa.Table:
        out = _counted(table, parts)
        release()
        return out

    def gathered_in(table: pa.Table) -> pa.Table:
        out = _gathered(table, percent)
        release()
        return out

    counted = written(sent.groupBy("fragment").applyInArrow(counted_in, _COUNTED), "fragments")
    members = counted.where("bucket is null").select("m_id", "m_text", "m_k", "m_n").mapInArrow(_members, "doc_id long, text_hash long, k long, n long")
    dealt = counted.where("bucket is not null").drop("m_id", "m_text", "m_k", "m_n").repartition(parts, "bucket")
    return written(members, "members"), written(dealt.groupBy("bucket").applyInArrow(gathered_in, _CLASS), "classes")


def _near_enough(a: str, b: str, percent: int) -> Column:
    """Bounds that any linked pair keeps: lengths, and n-grams on one side only (own ones, and bits that differ)."""
    x, y = (lambda c: F.col(f"{a}{c}")), (lambda c: F.col(f"{b}{c}"))
    apart = sum((F.bit_count(x(f"b{i}").bitwiseXOR(y(f"b{i}"))) for i in range(BITMAP_WORDS)), x("own") + y("own"))
    lengths = (100 * F.least(x("n"), y("n"))) >= percent * F.greatest(x("n"), y("n"))
    return lengths & ((100 + percent) * apart <= (100 - percent) * (x("n") + y("n")))


def _verified(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb) that are links: overlaps counted per fragment of the global order, summed per pair."""
    left = segments.select(F.col("rep").alias("a"), "band", F.col("grams").alias("ga"))
    right = segments.select(F.col("rep").alias("b"), "band", F.col("grams").alias("gb"))
    partial_counts = pairs.join(left, "a").join(right, ["b", "band"]).select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).alias("part"))
    summed = partial_counts.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("both"))
    return summed.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def _links_by_rounds(reps: DataFrame, percent: int) -> DataFrame:
    """(node, root) over the classes that are linked with another."""
    bits = [f"b{i}" for i in range(BITMAP_WORDS)]
    prefix = F.expr(f"cast(n - ceil({percent} * n / 100.0) + 1 - own as int)")
    postings = written(reps.select("rep", "n", "own", *bits, F.explode(F.slice("grams", 1, prefix)).alias("gram")), "postings")
    band = F.explode(F.expr("array_distinct(transform(seen, s -> cast(log2(s) as int)))"))
    segments = reps.select("rep", "grams", "seen", band.alias("band")).select(
        "rep", "band", F.expr("transform(filter(arrays_zip(grams, seen), z -> cast(log2(z.seen) as int) = band), z -> z.grams)").alias("grams")
    )
    segments = written(segments, "segments")
    info = ["rep", "comp", "n", "own", *bits]
    roots, turn = None, 0
    while True:
        if roots is None:
            labelled = postings.withColumn("comp", F.col("rep")).withColumn("linked", F.lit(False))
        else:
            to = roots.withColumnRenamed("node", "rep").withColumnRenamed("root", "comp")
            labelled = postings.join(to, "rep", "left").withColumn("linked", F.col("comp").isNotNull()).withColumn("comp", F.coalesce("comp", "rep"))
        labelled = written(labelled, "postings")
        # The hub has few n-grams of its own, as the original of a group of edited copies has; later it is a class that
        # no earlier hub has linked.
        central = F.struct("linked", F.col("own").alias("few"), F.xxhash64("rep", F.lit(turn)).alias("key"), *info)
        hubs = labelled.groupBy("gram").agg(F.min(central).alias("hub"), F.min("comp").alias("low"), F.max("comp").alias("high"))
        hubs = written(hubs.where("low < high").select("gram", *[F.col(f"hub.{c}").alias(f"h_{c}") for c in info]), "hubs")
        open_lists = labelled.join(hubs.select("gram"), "gram", "left_semi")
        pairs = labelled.join(hubs, "gram").where((F.col("comp") != F.col("h_comp")) & _near_enough("", "h_", percent))
        pairs = _ordered(pairs.select(F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("h_rep").alias("y"), F.col("h_n").alias("ny")))
        found = written(_verified(pairs, segments, percent), "links")
        before = open_lists.select("comp").distinct().count()
        roots, gained = _merged(roots, found)
        turn += 1
        if gained <= WORTHWHILE * before:
            break
    to = roots.withColumnRenamed("node", "rep").withColumnRenamed("root", "comp")
    labelled = postings.join(to, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    labelled = written(labelled, "postings")
    open_grams = written(labelled.groupBy("gram").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("gram"), "open")
    rest = written(labelled.join(open_grams, "gram", "left_semi"), "rest")
    # A long list is cut into blocks; each meets every block of its list in a key, and so in a task, of its own.
    lists = written(rest.groupBy("gram").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks")), "lists")
    rest = rest.join(lists, "gram").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = rest.select("gram", "block", *info, every.alias("against"))
    other = rest.select(F.col("gram").alias("h_gram"), F.col("block").alias("h_against"), *[F.col(c).alias(f"h_{c}") for c in info], every.alias("h_block"))
    same = (F.col("gram") == F.col("h_gram")) & (F.col("block") == F.col("h_block")) & (F.col("against") == F.col("h_against"))
    meet = (F.col("rep") < F.col("h_rep")) & (F.col("comp") != F.col("h_comp")) & _near_enough("", "h_", percent)
    pairs = left.join(other, same & meet).select(F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("h_rep").alias("y"), F.col("h_n").alias("ny"))
    return _merged(roots, written(_verified(_ordered(pairs), segments, percent), "links"))[0]


def _ordered(pairs: DataFrame) -> DataFrame:
    swap = F.col("x") > F.col("y")
    return pairs.select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.when(swap, F.col("ny")).otherwise(F.col("nx")).alias("na"), F.when(swap, F.col("nx")).otherwise(F.col("ny")).alias("nb")
    ).distinct()


def _merged(roots: DataFrame | None, links: DataFrame) -> tuple[DataFrame, int]:
    """Roots after the links are added, and how many components fewer there are."""
    if roots is None:
        new = contracted(links)
        return new, new.where("node <> root").count()
    to = roots.select(F.col("node"), F.col("root").alias("at"))
    edges = links
    for side in ("a", "b"):
        edges = edges.join(to.withColumnRenamed("node", side), side, "left").withColumn(side, F.coalesce("at", side)).drop("at")
    new = contracted(edges)
    moved = roots.join(new.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    added = new.join(roots.select("node"), "node", "left_anti").select("node", "root")
    return written(moved.union(added), "roots"), new.where("node <> root").count()


def membership(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, text_hash, n, component, component_id) of every row of `docs` (doc_id, text, text_hash) with a doc_id.

    component tells components apart even where one doc_id stands on several texts; it is null for empty sets.
    """
    members, classes = sets_by_class(docs.where("doc_id is not null"), size, percent)
    firsts = members.where("n > 0").groupBy("k", "n").agg(F.min("doc_id").alias("first"))
    # Classes are numbered in the order of their smallest documents, so a component's smallest class has its smallest document.
    firsts = written(firsts.orderBy("first", "k", "n").withColumn("rep", F.monotonically_increasing_id()), "firsts")
    reps = written(classes.join(firsts.drop("first"), ["k", "n"]), "reps")
    roots = _links_by_rounds(reps, percent).where("node <> root").join(firsts.select(F.col("rep").alias("root"), F.col("first").alias("low")), "root")
    placed = firsts.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    placed = written(placed.select("k", "n", F.coalesce("root", "rep").alias("component"), F.coalesce("low", "first").alias("component_id")), "placed")
    blank = members.where("n = 0").select("doc_id", "text_hash", "n", F.lit(None).cast("long").alias("component"), F.col("doc_id").alias("component_id"))
    return members.where("n > 0").join(placed, ["k", "n"]).select("doc_id", "text_hash", "n", "component", "component_id").unionByName(blank)


def _hashed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs` (doc_id, text; other columns are ignored).

    A document's set holds its distinct runs of `size` words, A-Z lower-cased, words parted by ASCII white space; the whole
    sequence if it has fewer. Two documents link if 100 * intersection >= percent * union. component_id is the smallest
    doc_id reachable by links. A null, empty or blank text has an empty set and is its own component. A row without doc_id
    takes no part: its size is 0 and its component null. Repeated rows come out as often as they went in; unlike texts under one doc_id
    are documents of their own. N-grams are 64-bit hashes; a class is a 64-bit digest and the size
    of its set.
    """
    rows = _hashed(docs)
    found = membership(rows, size, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    nameless = rows.where("doc_id is null").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return found.unionByName(nameless)


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Rows of `docs`, all columns, without near duplicates: of each component its smallest doc_id stays, once.

    Of several texts under that doc_id in one component the one with the smallest hash stays, of rows equal in doc_id and
    text the one whose columns have the smallest hash. Texts of one doc_id in different components stay each. Rows without
    doc_id all stay, as do null and empty texts, once for each doc_id. Columns named as the made ones keep their values.
    """
    rows = membership(_hashed(docs), size, percent)
    counted = rows.groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("times"))
    first = counted.where("component is not null").groupBy("component").agg(F.min(F.struct("doc_id", "text_hash", "times")).alias("d")).select("d.*")
    kept = written(first.union(counted.where("component is null").drop("component")), "kept")
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    named = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(F.col("text").cast("string")).alias("_text"), every.alias("_row")).where("_id is not null")

    short = kept.count() <= BROADCAST_ROWS

    def among(some: DataFrame) -> DataFrame:
        some = F.broadcast(some) if short else some
        return named.join(some, (F.col("_id") == some["doc_id"]) & (F.col("_text") == some["text_hash"]), "left_semi")

    # Only rows that are repeated are brought together; the others stay where they are unless that list is long.
    same = Window.partitionBy("_id", "_text").orderBy(F.xxhash64(F.to_json("_row")))
    once = among(kept.where("times > 1")).withColumn("_n", F.row_number().over(same)).where("_n = 1").select("_row.*")
    return among(kept.where("times = 1")).select("_row.*").unionByName(once).unionByName(docs.where("doc_id is null"))
