"""Quality by hierarchical empirical Bayes: a document classifier's evidence, combined with what is known of its site.

A logistic classifier over counts of the whole text, fitted on a bounded sample of labelled documents, gives every document
odds. Sources stand for hosts, a source's languages for its paths. Each host's rate of good documents is shrunk towards the
global rate, each path's towards its host's, by as much as the spread between groups warrants (method of moments). A
document's posterior odds are its evidence times the prior odds of its path.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.ngram_join import slices
from martloom.llm.shared import release, written
from martloom.llm.text_arrays import NOT_SPACE, Words, utf8_buffer

#: Labelled documents that the classifier is fitted on at most: those with the smallest hashes of their ids.
SAMPLE = 20_000
SEED = 11
#: A document is kept if its posterior is at least this.
KEEP = 0.5
#: Words that a repeated word counts against, so that long texts are not taken for repetitive.
_SPAN = 256
_RIDGE, _STEPS = 1e-2, 30
#: Bytes of text whose features are measured at a time; some 35 times as many are held meanwhile.
MEASURED_BYTES = 1 << 20


def _class(bytes_: str | range) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[*(bytes_.encode() if isinstance(bytes_, str) else bytes_)]] = True
    return table


_KINDS = (
    _class("abcdefghijklmnopqrstuvwxyz"),
    _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    _class("0123456789"),
    _class(range(0x80, 0x100)),
    _class(".,;:?'"),
    _class('!"#$%&()*+-/<=>@[]^_`{|}~\\'),
    _class("\n"),
)
FEATURES = 1 + len(_KINDS) + 5


def features(texts: pa.Array) -> np.ndarray:
    """One row a text: a constant, shares of kinds of bytes, word length, repetition, length. Empty texts have zeros."""
    data, at = utf8_buffer(texts)
    size = np.diff(at)
    doc = np.repeat(np.arange(len(size)), size)
    out = np.zeros((len(size), FEATURES))
    out[:, 0] = 1
    length = np.maximum(size, 1)
    for i, kind in enumerate(_KINDS, start=1):
        out[:, i] = np.bincount(doc[kind[data]], minlength=len(size)) / length
    words = Words(texts, NOT_SPACE)
    n = words.counts()
    owner = np.repeat(np.arange(len(n)), n)
    k = 1 + len(_KINDS)
    out[:, k] = np.log1p(size / np.maximum(n, 1))
    out[:, k + 1] = np.log1p(n)
    # A word that occurred among the span's words before: the share of such words, and of words equal to the one before.
    order = np.lexsort((np.arange(len(owner)), words.hash, owner))
    same = (words.hash[order][1:] == words.hash[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    apart = np.diff(order)
    out[:, k + 2] = np.bincount(owner[order][1:][same & (apart <= _SPAN)], minlength=len(n)) / np.maximum(n, 1)
    out[:, k + 3] = np.bincount(owner[order][1:][same & (apart == 1)], minlength=len(n)) / np.maximum(n, 1)
    out[:, k + 4] = n == 0
    return out


class Classifier:
    """Logistic regression by Newton steps with a small ridge, over scaled features."""

    def __init__(self, x: np.ndarray, good: np.ndarray) -> None:
        self.mean, spread = x.mean(axis=0), x.std(axis=0)
        self.scale = np.where(spread > 0, spread, 1)
        self.mean[0], self.scale[0] = 0, 1
        z, self.weights = (x - self.mean) / self.scale, np.zeros(x.shape[1])
        self.base = float(np.clip((good.sum() + 1) / (len(good) + 2), 1e-3, 1 - 1e-3))
        for _ in range(_STEPS):
            p = self._sigmoid(z @ self.weights)
            slope = z.T @ (p - good) + _RIDGE * len(z) * self.weights * (np.arange(z.shape[1]) > 0)
            bend = (z * (p * (1 - p))[:, None]).T @ z + (_RIDGE * len(z) + 1e-9) * np.eye(z.shape[1])
            step = np.linalg.solve(bend, slope)
            self.weights -= step
            if np.abs(step).max() < 1e-8:
                break

    @staticmethod
    def _sigmoid(t: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(t, -30, 30)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self._sigmoid(((x - self.mean) / self.scale) @ self.weights)


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier | None:
    """The classifier, from at most `sample` labelled documents; None if the labels do not tell two kinds apart."""
    clear = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    some = clear.where("quality = other").select("doc_id", "quality").orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(sample)
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_hash")).join(F.broadcast(some), "doc_id")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", MEASURED_BYTES):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(list(features(part.column("text")))), part.column("quality").cast(pa.int32())], ["doc_id", "text_hash", "x", "quality"])

    found = rows.mapInArrow(measured, "doc_id long, text_hash long, x array<double>, quality int")
    table = found.groupBy("doc_id").agg(F.min_by(F.struct("x", "quality"), "text_hash").alias("f")).select("doc_id", "f.*").orderBy("doc_id").limit(sample).toArrow()
    good = np.asarray(table["quality"].combine_chunks(), dtype=float)
    if len(set(good.tolist())) < 2:
        return None
    return Classifier(np.array(table["x"].to_pylist()), good)


def probability(classifier: Classifier | None, text: str) -> Column:
    """The classifier's probability of a good document from the whole text. Only texts go to Python, and only numbers come back."""
    if classifier is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def measured(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            parts = slices(pa.RecordBatch.from_arrays([batch], ["text"]), "text", MEASURED_BYTES)
            yield pa.concat_arrays([pa.array(classifier.probability(features(p.column("text")))) for p in parts] or [pa.array([], pa.float64())])
        release()

    return measured(F.col(f"`{text}`").cast("string"))


def _strength(groups: DataFrame, rate: str) -> Column:
    """Documents that a group's prior counts for: p(1 - p) / variance between groups - 1, by the method of moments."""
    n, mean = F.col("n"), F.col("total") / F.col("n")
    about = F.col(rate)
    inside = F.sum(about * (1 - about))
    between = F.sum(n * (mean - about) ** 2) - inside
    weight = F.sum(n) - F.sum(n * n) / F.sum(n)
    variance = F.when(weight > 0, between / weight)
    spread = F.sum(n * about * (1 - about)) / F.sum(n)
    ratio = F.when(variance > 0, spread / variance - 1).otherwise(1e6)
    return F.greatest(F.lit(1.0), F.least(F.lit(1e6), F.coalesce(ratio, F.lit(1e6))))


def path_priors(scores: DataFrame) -> DataFrame:
    """(host, path, host_rate, path_rate) from `scores` (host, path, p): grouped sums, then shrinkage down the levels."""
    paths = written(scores.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("total")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    hosts = hosts.crossJoin(F.broadcast(paths.agg((F.sum("total") / F.sum("n")).alias("rate"))))
    hosts = written(hosts, "hosts")
    hosts = hosts.crossJoin(F.broadcast(hosts.agg(_strength(hosts, "rate").alias("weight"))))
    hosts = written(hosts.select("host", ((F.col("total") + F.col("weight") * F.col("rate")) / (F.col("n") + F.col("weight"))).alias("host_rate")), "host-rates")
    paths = written(paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).drop(hosts["host"]), "paths")
    paths = paths.crossJoin(F.broadcast(paths.agg(_strength(paths, "host_rate").alias("weight"))))
    rate = (F.col("total") + F.col("weight") * F.col("host_rate")) / (F.col("n") + F.col("weight"))
    return written(paths.select("host", "path", "host_rate", rate.alias("path_rate")), "path-rates")


def _logit(p: Column) -> Column:
    bounded = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.ln(bounded / (1 - bounded))


#: Columns that `judged` adds.
MADE = ("evidence", "host_rate", "path_rate", "posterior", "kept")


def judged(docs: DataFrame, labels: DataFrame, keep: list[str], host: str = "source", path: str = "lang", sample: int = SAMPLE, least: float = KEEP) -> DataFrame:
    """Columns `keep` of `docs` with evidence, host_rate, path_rate, posterior and kept.

    A null host or path is one of its own. A null or empty text is judged by its features, all zero but for that of having no words.
    Labels that are null, other than 0 or 1, or contradict each other are left out; without two kinds of labels the evidence is
    0.5 and everything is kept. Repeated rows are judged alike. Columns of `docs` named as the made ones are replaced. An empty
    table gives no rows.
    """
    keep = [c for c in keep if c not in MADE]
    classifier = fitted(docs, labels, sample)
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    at = [F.col(f"`{c}`").cast("string").alias(name) for c, name in ((host, "host"), (path, "path"))]
    # Every text is read and scored once; the columns kept go on with its score.
    rows = written(docs.select(row, *at, probability(classifier, "text").alias("p")), "scored")
    priors = path_priors(rows).withColumnsRenamed({"host": "_host", "path": "_path"})
    found = rows.join(priors, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))
    odds = _logit(F.col("p")) - _logit(F.lit(classifier.base if classifier else 0.5)) + _logit(F.col("path_rate"))
    found = found.withColumn("posterior", 1 / (1 + F.exp(-odds)))
    kept = F.col("posterior") >= least if classifier else F.lit(True)
    return found.select("row.*", F.col("p").alias("evidence"), "host_rate", "path_rate", "posterior", kept.alias("kept"))


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of `docs`, its columns, that are kept."""
    held = docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    return judged(held, labels, ["_row"]).where("kept").select("_row.*")
