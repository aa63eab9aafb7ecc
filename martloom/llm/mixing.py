"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source's documents lie in blocks by a keyed hash, about equal in words. A source's target is met by whole blocks, once or twice
through the source, and by documents of one more block, taken in order as long as they fit; room that is left goes on to the blocks
after it, until no document left in the source fits. The numbers of blocks drawn are exact quotas; a tree
over the output shards halves them again and again, each time by a multivariate-hypergeometric draw, so every shard's
share of every source is random and all blocks are used once. A shard's blocks are a stretch of the source's permuted
blocks, and its rows are shuffled by hash within it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from martloom.llm.shared import written

WEIGHTS, SHARE, REPEATS = (3, 1, 2), 1.5, 2
BLOCK_WORDS, SHARDS, SEED = 20_000, 32, 7
WORD = r"[^\x20\x09-\x0D]+"
#: Blocks whose words are added up in one task.
TOGETHER = 1024
#: Words of an output shard, once there are more than SHARDS of them.
SHARD_WORDS = 32_000_000
_LARGEST = float(1 << 63)


def _source_key(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col(column)), F.lit("n"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """`sizes` (source, source_size) with weight and target.

    Sources in code-point order, null last, have the weights in turn. They share `share` times all words by weight; a target stops at
    `repeats` times its source, and the excess is shared by weight again. That is min(cap, level * weight) for the one
    level at which targets add up: sources sorted by cap / weight are capped up to some place.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    t = sizes.withColumn("weight", turn).withColumn("cap", F.col("source_size") * float(repeats))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("goal", share * F.sum("source_size").over(Window.partitionBy())).withColumn("weights", F.sum("weight").over(Window.partitionBy()))
    left = F.col("goal") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    t = t.withColumn("level", left / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    fitting = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    level = F.max(fitting).over(Window.partitionBy())
    first = F.min(F.when(fitting.isNotNull(), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"), F.col("level").alias("level")))).over(Window.partitionBy())
    target = F.when(level.isNull(), F.col("cap")).otherwise(F.least("cap", first["level"] * F.col("weight")))
    return t.select("source", "source_size", "weight", target.cast("double").alias("target"))


def _log_factorial(n: str) -> str:
    """ln n!, exact up to 20, else by Stirling's series, good to 1e-12."""
    return f"(CASE WHEN {n} <= 20 THEN ln(factorial(cast({n} as int))) ELSE {n} * ln({n}) - {n} + 0.5 * ln(6.283185307179586 * {n}) + 1 / (12D * {n}) - 1 / (360D * {n} * {n} * {n}) + 1 / (1260D * pow({n}, 5)) END)"


def _draw(total: str, good: str, drawn: str, chance: str) -> str:
    """Hypergeometric draw by inversion around the mode: how many of `good` out of `total` are among `drawn`."""
    let = lambda name, value, body: f"element_at(transform(array({value}), {name} -> {body}), 1)"
    log_p = lambda x: "-".join(["0"] + [_log_factorial(f"({y})") for y in (x, f"g - {x}", f"n - {x}", f"t - g - n + {x}")])
    pick = "aggregate(w, named_struct('sum', 0D, 'at', 0L), (acc, p) -> IF(acc.sum < u * s, named_struct('sum', acc.sum + p, 'at', acc.at + 1), acc), acc -> lo + greatest(acc.at, 1L) - 1)"
    body = let("s", "aggregate(w, 0D, (acc, p) -> acc + p)", pick)
    body = let("w", f"transform(sequence(lo, hi), x -> exp(({log_p('x')}) - top))", body)
    body = let("top", log_p("m"), body)
    body = let("hi", "least(least(n, g), m + r)", body)
    body = let("lo", "greatest(greatest(0L, n - (t - g)), m - r)", body)
    body = let("m", "least(least(n, g), greatest(greatest(0L, n - (t - g)), cast(floor((n + 1D) * (g + 1D) / (t + 2D)) as bigint)))", body)
    body = let("r", "cast(10 + ceil(10 * sqrt(greatest(0D, cast(n as double) * g * (t - g) * (t - n) / (cast(t as double) * t * greatest(1, t - 1))))) as bigint)", body)
    for name, value in (("u", chance), ("n", drawn), ("g", good), ("t", total)):
        body = let(name, value, body)
    return f"IF({good} = 0 OR {drawn} = 0, 0L, IF({drawn} = {total}, {good}, {body}))"


def splitting_tree(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """`quotas` (src, blocks) parted exactly among `shards`: (shard, src, begin, blocks), begin counting the source's blocks."""
    listed = F.array_sort(F.collect_list(F.struct("src", F.lit(0).cast("long").alias("begin"), "blocks")))
    nodes = quotas.where("blocks > 0").agg(listed.alias("parts")).select(F.lit(0).alias("shard"), F.lit(shards).alias("width"), "parts")
    chance = f"shiftrightunsigned(xxhash64({seed}, shard, width, p.src), 11) / 9007199254740992D"
    step = f"""aggregate(parts,
        named_struct('t', aggregate(parts, 0L, (s, p) -> s + p.blocks),
                     'n', cast(floor(aggregate(parts, 0L, (s, p) -> s + p.blocks) * cast(width div 2 as double) / width) as bigint),
                     'x', cast(array() as array<bigint>)),
        (a, p) -> element_at(transform(array({_draw("a.t", "p.blocks", "a.n", chance)}), d -> named_struct('t', a.t - p.blocks, 'n', a.n - d, 'x', concat(a.x, array(d)))), 1),
        a -> a.x)"""
    left = "transform(arrays_zip(parts, x), z -> named_struct('src', z.parts.src, 'begin', z.parts.begin, 'blocks', z.x))"
    right = "transform(arrays_zip(parts, x), z -> named_struct('src', z.parts.src, 'begin', z.parts.begin + z.x, 'blocks', z.parts.blocks - z.x))"
    kind = "array<struct<src:string,begin:bigint,blocks:bigint>>"
    widest = shards
    while widest > 1:
        drawn = nodes.withColumn("x", F.when(F.col("width") > 1, F.expr(step)))
        halves = F.expr(f"""IF(width > 1,
            array(named_struct('shard', shard, 'width', cast(width div 2 as int), 'parts', cast({left} as {kind})),
                  named_struct('shard', cast(shard + width div 2 as int), 'width', cast(width - width div 2 as int), 'parts', cast({right} as {kind}))),
            array(named_struct('shard', shard, 'width', width, 'parts', cast(parts as {kind}))))""")
        nodes = written(drawn.select(F.explode(halves).alias("h")).select("h.*"), "tree")
        widest -= widest // 2
    return nodes.select("shard", F.explode("parts").alias("p")).select("shard", "p.src", "p.begin", "p.blocks").where("blocks > 0")


def _earlier(*by: str) -> WindowSpec:
    return Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)


def _started(blocks: DataFrame) -> DataFrame:
    """`blocks` (src, block, words) with start, the words of the source's blocks before; added up in groups of blocks."""
    group = F.floor(F.col("block") / TOGETHER)
    groups = blocks.groupBy("src", group.alias("group")).agg(F.sum("words").alias("words"))
    groups = groups.select("src", "group", F.coalesce(F.sum("words").over(_earlier("src").orderBy("group")), F.lit(0)).alias("group_start"))
    start = F.col("group_start") + F.coalesce(F.sum("words").over(_earlier("src", "group").orderBy("block")), F.lit(0))
    return blocks.withColumn("group", group).join(groups, ["src", "group"]).withColumn("start", start).drop("group", "group_start")


def _filled(inside: DataFrame) -> DataFrame:
    """(src, block, left, chosen, words): `inside` (src, block, room, key, size) taken by key as long as it fits."""
    listed = inside.groupBy("src", "block", "room").agg(F.array_sort(F.collect_list(F.struct("key", "size"))).alias("rows"))
    fill = """aggregate(rows, named_struct('left', cast(room as double), 'keys', cast(array() as array<bigint>), 'words', 0L),
        (a, x) -> IF(x.size <= a.left, named_struct('left', a.left - x.size, 'keys', concat(a.keys, array(x.key)), 'words', a.words + x.size), a))"""
    return listed.select("src", "block", F.expr(fill).alias("f")).select("src", "block", "f.left", F.col("f.keys").alias("chosen"), "f.words")


def _carried(loose: DataFrame, room: DataFrame) -> list[DataFrame]:
    """(src, block, chosen, words) of documents `loose` (src, block, key, size) that fill `room` (src, after, room) from blocks beyond `after`.

    A round takes documents of at most half the room. Where not all of them fit, the one that does not leaves less than half of the
    room for the blocks after it, so rounds are few; where all fit, one larger document may follow, and no other fits.
    """
    taken = []
    while True:
        loose = written(loose.drop("after", "room").join(room, "src").where("block > after and size <= room"), "loose")
        if loose.isEmpty():
            return taken
        small = loose.where("size <= room / 2")
        sums = written(_started(small.groupBy("src", "block", "room").agg(F.sum("size").alias("words"))), "starts")
        fits = sums.where("start + words <= room").select("src", "block")
        taken.append(small.join(fits, ["src", "block"]).groupBy("src", "block").agg(F.collect_list("key").alias("chosen"), F.sum("size").alias("words")))
        crossed = sums.where("start <= room and start + words > room").select("src", "block", (F.col("room") - F.col("start")).alias("room"))
        filled = written(_filled(small.drop("room").join(crossed, ["src", "block"])), "filled")
        taken.append(filled.select("src", "block", "chosen", "words"))
        total = F.coalesce(F.sum(F.when(F.col("size") <= F.col("room") / 2, F.col("size"))), F.lit(0))
        ended = loose.groupBy("src", "room").agg(total.alias("total")).where("total <= room").select("src", (F.col("room") - F.col("total")).alias("end"))
        last = loose.where("size > room / 2").join(ended, "src").where("size <= end").groupBy("src").agg(F.min(F.struct("block", "key", "size")).alias("d"))
        taken.append(last.select("src", "d.block", F.array("d.key").alias("chosen"), F.col("d.size").alias("words")))
        room = filled.select("src", F.col("block").alias("after"), F.col("left").alias("room"))


def _draws(docs: DataFrame, weights: tuple[int, ...], share: float, repeats: int, shards: int | None, block_words: int, seed: int) -> tuple[DataFrame, DataFrame, int]:
    """(docs with src, size, key and block; per src and block: target, source size, shards of each pass, keys of a part; shards)."""
    key = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 1)
    sized = docs.withColumn("src", _source_key("source")).withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")).withColumn("key", key)
    light = written(sized.select("source", "src", "size", "key"), "sizes")
    per_source = targets(light.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeats)
    per_source = per_source.withColumn("src", _source_key("source")).withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)))
    per_source = per_source.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    per_source = written(per_source.withColumn("part", F.col("target") - F.col("passes") * F.col("source_size")).drop("source"), "targets")
    block = F.least(F.col("n_blocks") - 1, F.floor(F.col("key") / _LARGEST * F.col("n_blocks"))).cast("long")
    placed = light.join(per_source.select("src", "n_blocks"), "src").withColumn("block", block)
    blocks = written(placed.groupBy("src", "block").agg(F.sum("size").alias("words")), "blocks")
    blocks = _started(blocks).join(per_source, "src")
    room = F.col("part") - F.col("start")
    blocks = written(blocks.select("src", "block", "words", "target", "source_size", "n_blocks", "passes", room.alias("room")), "blocks")
    split = blocks.where("room > 0 and words > room").select("src", "block", "room", "n_blocks")
    inside = light.where("size > 0").join(split, "src").where(block == F.col("block")).groupBy("src", "block", "room", "key").agg(F.sum("size").alias("size"))
    filled = written(_filled(inside), "filled")
    room = filled.select("src", F.col("block").alias("after"), F.col("left").alias("room"))
    after = placed.where("size > 0").join(room, "src").where("block > after and size <= room")
    loose = after.groupBy("src", "block", "key").agg(F.sum("size").alias("size"))
    chosen = filled.select("src", "block", "chosen", "words")
    for more in _carried(loose, room):
        chosen = chosen.union(more)
    chosen = chosen.where(F.size("chosen") > 0).groupBy("src", "block").agg(F.flatten(F.collect_list("chosen")).alias("chosen"), F.sum("words").alias("chosen_words"))
    blocks = blocks.join(written(chosen, "chosen"), ["src", "block"], "left")
    whole = ((F.col("room") > 0) & (F.col("words") <= F.col("room"))) | F.coalesce(F.col("chosen_words") == F.col("words"), F.lit(False))
    partly = whole | F.col("chosen").isNotNull()
    # Draws of a source: all blocks for each whole pass, then those of the part; numbered, then permuted.
    turns = F.when(partly, F.col("passes")).otherwise(F.col("passes") - 1)
    drawn = blocks.where(turns >= 0).select("src", "block", F.explode(F.sequence(F.lit(0).cast("long"), turns)).alias("turn"))
    quota = written(blocks.where(turns >= 0).groupBy("src").agg(F.sum(turns + 1).alias("blocks")), "quotas")
    shards = shards or max(SHARDS, math.ceil((per_source.agg(F.sum("target")).first()[0] or 0) / SHARD_WORDS))
    tree = splitting_tree(quota, shards, seed)
    to = tree.select("src", "shard", F.explode(F.expr("sequence(begin, begin + blocks - 1)")).alias("place"))
    # A source's draws are permuted by numbering them in the order of a keyed hash; groups of a hash prefix each are numbered on
    # their own, so that no task numbers a whole source.
    hashed = drawn.join(quota, "src").withColumn("h", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "src", "block", "turn", F.lit("place")), 1))
    groups = F.ceil(F.col("blocks") / TOGETHER)
    hashed = written(hashed.withColumn("group", F.least(groups - 1, F.floor(F.col("h") / _LARGEST * groups))), "hashed")
    counts = hashed.groupBy("src", "group").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("src", "group", F.coalesce(F.sum("n").over(_earlier("src").orderBy("group")), F.lit(0)).alias("base"))
    number = F.col("base") + F.row_number().over(Window.partitionBy("src", "group").orderBy("h", "block", "turn")) - 1
    numbered = hashed.join(counts, ["src", "group"]).withColumn("place", number)
    shard_of = numbered.join(to, ["src", "place"]).groupBy("src", "block").agg(*[F.max(F.when(F.col("turn") == t, F.col("shard"))).alias(f"shard{t}") for t in range(repeats)])
    plan = blocks.join(shard_of, ["src", "block"], "left").select("src", "block", "target", "source_size", "n_blocks", "passes", whole.alias("whole"), "chosen", *[f"shard{t}" for t in range(repeats)])
    plan = written(plan, "plan")
    count = per_source.select(F.col("src").alias("_src"), F.col("n_blocks").alias("_n"))
    home = F.least(F.col("_n") - 1, F.floor(F.col("key") / _LARGEST * F.col("_n"))).cast("long")
    return sized.join(count, F.col("src") == F.col("_src")).withColumn("block", home).drop("_src", "_n"), plan, shards


def _taken(repeats: int) -> Column:
    """Shards of a document's draws, one for each time that it is taken."""
    part = F.col("whole") | F.coalesce(F.array_contains("chosen", F.col("key")), F.lit(False))
    return F.array_compact(F.array(*[F.when((F.lit(t) < F.col("passes")) | ((F.lit(t) == F.col("passes")) & part), F.col(f"shard{t}")) for t in range(repeats)]))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, shards: int | None = None, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """Per row of `docs` (doc_id, text, source): doc_id, size, source_size, target, taken and its output shards.

    size counts runs of anything but ASCII white space; a null or empty text has none and is never taken beyond 0 words. A source takes its
    target but for fewer words than any document has that the part of a pass leaves. Rows equal in doc_id and text are taken or left together. A
    null source is a source; an empty table gives no rows.
    """
    rows, plan, shards = _draws(docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source")), weights, share, repeats, shards, block_words, seed)
    rows = rows.select("doc_id", "src", "size", "key", "block").join(plan, ["src", "block"])
    return rows.withColumn("shards", _taken(repeats)).select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), "shards")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, shards: int | None = None, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The mix itself: rows of `docs`, its columns, as often as taken, shard by shard, each shard in shuffled order.

    Rows without words are in the mix as often as their block is drawn. The number of shards grows with the words unless it is given.
    """
    held = docs.select("doc_id", "text", "source", F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"))
    rows, plan, shards = _draws(held, weights, share, repeats, shards, block_words, seed)
    rows = rows.select("row", "src", "key", "block").join(plan, ["src", "block"]).select("row", "key", F.explode(_taken(repeats)).alias("shard"))
    order = F.xxhash64("key", "shard", F.lit(seed))
    return rows.repartition(shards, "shard").sortWithinPartitions("shard", order).select("row.*")
