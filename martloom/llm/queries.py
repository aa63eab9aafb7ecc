"""The operators of this subpackage as queries over whole tables, with production parameters, and as SQL where it can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import (
    centroids,
    decontaminate,
    license_scan,
    mixing,
    ngram_join,
    packing,
    pseudonyms,
    ranked_search,
    sharding,
    site_quality,
    token_records,
    topk_search,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_extendible_sharding(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.sharded(_table(spark, folder, "documents"))
    return rows.select("doc_id", "shard", "shard_bytes", "shard_rows")


def op2_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymised(docs, key="martloom2")


def op3_license_digests(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(_table(spark, folder, "documents"), license_scan.known_table(spark))


def op4_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


#: Rules of the filter over pages: host, path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judged(pages, url_filter.rule_table(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


def op6_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Queries are the rows whose id is divisible by 20, against all rows."""
    vectors = topk_search.whole_numbers(_table(spark, folder, "embeddings"))
    return topk_search.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op7_site_quality(spark: SparkSession, folder: str) -> DataFrame:
    return site_quality.judged(_table(spark, folder, "documents"), _table(spark, folder, "labels"), keep=["doc_id", "source", "lang"])


def op8_token_records(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_records.token_table(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Four-word shingles, Jaccard similarity of 85 in 100 or more."""
    return ngram_join.near_duplicates(_table(spark, folder, "documents"), size=4, percent=85)


def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    rows = decontaminate.judged(decontaminate.contamination(docs, _table(spark, folder, "benchmark")))
    names = F.sha2(F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ","), 256)
    return rows.select("doc_id", "n_words", "n_hit", "n_items", names.alias("items_sha256"), "contaminated")


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best of all documents for each benchmark item."""
    return ranked_search.ranked(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), k=10)


def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """40 clusters after five rounds."""
    vectors = centroids.whole_numbers(_table(spark, folder, "embeddings"))
    rows, final = centroids.clustered(vectors, k=40, rounds=5, seed=2)
    names = spark.createDataFrame(list(enumerate(centroids.digests(final))), "cluster int, centroid_sha256 string")
    return rows.join(F.broadcast(names), "cluster")


def op13_window_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Sequences of 2,048 tokens."""
    import public_tokenizers

    return packing.piece_table(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_extendible_sharding,
        op2_pii_pseudonyms,
        op3_license_digests,
        op4_source_mixing,
        op5_url_filter,
        op6_exact_topk,
        op7_site_quality,
        op8_token_records,
        op9_ngram_jaccard_join,
        op10_benchmark_decontamination,
        op11_ranked_search,
        op12_centroid_clusters,
        op13_window_packing,
    )
}



def _rounds_of_clustering(k: int = 40, rounds: int = 5, seed: int = 2) -> str:
    """Clustering of `embeddings` round by round: (nearest) has every vector's cluster, (means) the moved centroids."""
    distance = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    usable = "len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
    steps = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings WHERE {usable})""",
        f"""means0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS cluster, v AS c
            FROM kept QUALIFY row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) <= {k})""",
    ]
    for r in range(rounds + 1):
        steps.append(f"""nearest{r} AS MATERIALIZED (SELECT id, vec_id, any_value(v) AS v, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
            FROM (SELECT id, vec_id, v, cluster, {distance} AS distance FROM kept, means{r}) GROUP BY id, vec_id)""")
        if r < rounds:
            steps.append(f"""sums{r} AS (SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n
            FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM nearest{r}) GROUP BY cluster, i)""")
            steps.append(f"""means{r + 1} AS MATERIALIZED (SELECT cluster, coalesce(m, c) AS c FROM means{r}
            LEFT JOIN (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM sums{r} GROUP BY cluster) USING (cluster))""")
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
            sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM nearest{rounds} JOIN means{rounds} USING (cluster)"""


ORACLES: dict[str, str] = {
    "op5_url_filter": f"""
        WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
        rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
        parts AS (SELECT page_id, row_number() OVER () AS row_no,
                translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
        best AS (SELECT row_no, rule_host || rule_path AS rule, rule_verdict FROM parts JOIN rules
            ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            QUALIFY row_number() OVER (PARTITION BY row_no ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) = 1)
        SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (row_no)""",
    "op6_exact_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id,
                list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20""",
    "op11_ranked_search": """
        WITH terms AS (SELECT doc_no, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM (SELECT row_number() OVER () AS doc_no, doc_id, text FROM documents)),
        postings AS (SELECT doc_no, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
        lengths AS (SELECT doc_no, sum(tf)::BIGINT AS n FROM postings GROUP BY doc_no),
        totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths),
        weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, totals GROUP BY term, docs),
        wanted AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
        scores AS (SELECT item_id, doc_no, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))))::BIGINT AS score
            FROM wanted JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (doc_no), totals GROUP BY ALL)
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM scores WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10""",
    "op12_centroid_clusters": _rounds_of_clustering(),
}
