"""The pipeline's stages on the small tables, each against a brute-force version on its own input."""

import math
import re
from collections import Counter, defaultdict

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_llm_operators import components, lowered

import corpus_pipeline
from martloom.llm import mixing, site_quality


def strength(groups):
    """Documents that a prior counts for, from (n, total, about) of its groups."""
    n = sum(g[0] for g in groups)
    between = sum(k * (t / k - a) ** 2 for k, t, a in groups) - sum(a * (1 - a) for _, _, a in groups)
    weight = n - sum(k * k for k, _, _ in groups) / n
    variance = between / weight if weight > 0 else 0
    spread = sum(k * a * (1 - a) for k, _, a in groups) / n
    return min(1e6, max(1.0, spread / variance - 1 if variance > 0 else 1e6))


def logit(p):
    p = min(1 - 1e-6, max(1e-6, p))
    return math.log(p / (1 - p))


def posteriors(rows, base):
    """doc_id to (host rate, path rate, posterior), from (doc_id, host, path, evidence)."""
    paths, hosts = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for _, host, path, p in rows:
        for group in (paths[host, path], hosts[host]):
            group[0] += 1
            group[1] += p
    rate = sum(t for _, t in hosts.values()) / len(rows)
    w = strength([(n, t, rate) for n, t in hosts.values()])
    host_rate = {h: (t + w * rate) / (n + w) for h, (n, t) in hosts.items()}
    w = strength([(n, t, host_rate[h]) for (h, _), (n, t) in paths.items()])
    path_rate = {(h, q): (t + w * host_rate[h]) / (n + w) for (h, q), (n, t) in paths.items()}
    return {i: (host_rate[h], path_rate[h, q], 1 / (1 + math.exp(-(logit(p) - logit(base) + logit(path_rate[h, q]))))) for i, h, q, p in rows}


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_quality_by_hand(spark, documents):
    """Rates, posteriors and decisions recomputed from the evidence; a null source and columns of clashing names included."""
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    some = documents.withColumn("source", F.when(F.col("doc_id") % 11 > 0, F.col("source"))).withColumn("p", F.lit("x")).withColumn("host", F.lit(1))
    got = site_quality.judged(some, labels, ["doc_id", "source", "lang", "p", "host"]).collect()
    want = posteriors([(r.doc_id, r.source, r.lang, r.evidence) for r in got], site_quality.fitted(some, labels).base)
    for r in got:
        assert (r.host_rate, r.path_rate, r.posterior) == pytest.approx(want[r.doc_id], rel=1e-9)
        assert r.kept == (r.posterior >= 0.5) and r.p == "x" and r.host == 1
    assert sorted(site_quality.good(some, labels).select("doc_id").collect()) == sorted((r.doc_id,) for r in got if r.kept)
    assert site_quality.judged(some.limit(0), labels, ["doc_id"]).count() == 0


def test_stages(spark, documents):
    docs, stages = documents, dict(corpus_pipeline.STAGES)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources", "sharding"]

    def after(name):
        out = stages[name](spark, docs, SMALL).cache()
        rows = out.collect()
        if name != "sharding":
            assert out.columns == documents.columns
        return out, rows

    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    base = site_quality.fitted(docs, labels).base
    judged = site_quality.judged(docs, labels, ["doc_id", "source", "lang"]).collect()
    want = posteriors([(r.doc_id, r.source, r.lang, r.evidence) for r in judged], base)
    texts = {r.doc_id: r for r in docs.collect()}
    docs, rows = after("quality classifier")
    assert sorted(rows) == sorted(texts[i] for i, x in want.items() if x[2] >= 0.5) and len(rows) < len(texts)

    found = components([(r.doc_id, r.text) for r in rows], 5, 80)
    before = rows
    docs, rows = after("n-gram Jaccard join")
    assert sorted(rows) == sorted(r for r in before if found[r.doc_id][1] == r.doc_id) and len(rows) < len(before)

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = tuple(word.findall(lowered(r.text)))
        windows |= {w[k : k + 13] for k in range(max(0, len(w) - 13) + 1)} - {()}
    sizes = {len(w) for w in windows}

    def clean(text):
        w, hit = word.findall(lowered(text)), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
        return not hit or 20 * len(hit) < len(w)

    before = rows
    docs, rows = after("benchmark decontamination")
    assert sorted(rows) == sorted(r for r in before if clean(r.text))

    times = {r.doc_id: len(r.shards) for r in mixing.mix(docs).collect()}
    before = rows
    docs, rows = after("mixing sources")
    assert sorted(rows) == sorted(r for r in before for _ in range(times[r.doc_id]))

    before = rows
    docs, rows = after("sharding")
    assert sorted(r[: len(before[0])] for r in rows) == sorted(tuple(r) for r in before)
    size = Counter()
    for r in rows:
        size[r.shard] += len((r.text or "").encode())
    assert all(size[r.shard] == r.shard_bytes for r in rows)


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0


def test_python_work_holds_little():
    """Numpy's memory at its highest while 6 MB of text go through the classifier's features and the benchmark's index."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from martloom.llm import decontaminate, ngram_join, site_quality
    from martloom.llm.text_arrays import ALPHANUMERIC, Words

    rng = np.random.default_rng(3)
    words = np.array([f"w{i}" for i in range(2000)])
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(words[rng.integers(0, 2000, 1000)]) for _ in range(1100)])], ["text"])
    hashes = Words(pa.array([" ".join(words[:1900])]), ALPHANUMERIC).hash
    windows = pa.table({"words": pa.array([hashes[i : i + 13].tobytes() for i in range(0, 1880, 13)], pa.binary()), "item_id": pa.array(range(0, 1880, 13))})
    phrases = decontaminate.Phrases.of(windows, 13)

    def peak(work, most):
        tracemalloc.start()
        for part in ngram_join.slices(batch, "text", most):
            work(part.column("text"))
        held = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return held >> 20

    assert peak(site_quality.features, site_quality.MEASURED_BYTES) < 60
    assert peak(lambda texts: decontaminate._found(texts, phrases), decontaminate.SHARD_BYTES) < 90
    assert peak(lambda texts: decontaminate._found(texts, phrases), 6 << 20) > 100
