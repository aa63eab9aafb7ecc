"""Each operator against a brute-force version on small tables, and on nulls, empty texts, ties, repeats and empty tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import difference
from conftest import SMALL
from pyspark.sql import functions as F

from martloom.llm import decontaminate, license_scan, mixing, ngram_join, pseudonyms, sharding, site_quality, token_records, topk_search
from martloom.llm.queries import ORACLES, QUERIES

ODD = [(1, "a b c d e f"), (1, "a b c d e f"), (2, None), (3, ""), (4, " \n "), (None, "a b c d e f"), (5, "x"), (6, "X"), (7, "Ünïcode " * 3000), (8, "a b c d e f")]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def odd(spark, rows=ODD):
    return spark.createDataFrame([(i, t, t, "s", None) for i, t in rows], "doc_id long, text string, n_words string, source string, lang string")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), ORACLES[name], SMALL) == ""


def components(rows, size, percent):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        sets[i] = {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
    ids, root = sorted(sets), {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_ngram_join(spark, docs, size, percent):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs, size, percent).collect()}
    assert got == components(rows, size, percent)


def test_ngram_join_odd(spark):
    got = ngram_join.near_duplicates(odd(spark), 4, 85).collect()
    assert len(got) == len(ODD)
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in got}
    assert {(1, 3, 1), (8, 3, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 1, 5), (6, 1, 5), (None, 0, None)} <= found
    assert ngram_join.near_duplicates(odd(spark, [])).count() == 0
    assert sorted(r.doc_id or 0 for r in ngram_join.one_of_each(odd(spark)).collect()) == [0, 1, 2, 3, 4, 5, 7]


def test_one_id_on_unlike_texts(spark, monkeypatch):
    """A text that is no copy of another stays, whatever stands under its doc_id; of copies one row stays."""
    first, second, third = "a b c d e f g h", "q w e r t y u i", "z x c v b n m k"
    rows = [(1, first, 1), (1, second, 2), (2, first, 3), (1, first, 1), (1, first, 9), (4, second, 4), (3, None, 5), (3, None, 5), (5, third, 6), (4, third, 7)]
    table = spark.createDataFrame(rows, "doc_id long, text string, text_hash long")
    for block in (ngram_join.BLOCK_ROWS, 1):
        monkeypatch.setattr(ngram_join, "BLOCK_ROWS", block)
        monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", block - 1)
        for size in (ngram_join.FRAGMENT_BYTES, 20):
            monkeypatch.setattr(ngram_join, "FRAGMENT_BYTES", size)
            kept = [tuple(r) for r in ngram_join.one_of_each(table.repartition(3)).collect()]
            assert sorted(r[:2] for r in kept if r[1]) == [(1, first), (1, second), (4, third)]
            assert sum(r[0] == 3 for r in kept) == 1 and table.columns == ["doc_id", "text", "text_hash"]


def test_decontamination(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()] + [(900, "the of"), (901, None), (902, "..."), (None, "the")]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for name, text in items:
        w = tuple(word.findall(lowered(text)))
        if name is not None:
            for k in range(max(0, len(w) - 13) + 1) if w else ():
                windows[w[k : k + 13]].add(name)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] + ODD
    table = spark.createDataFrame(rows, SCHEMA).withColumn("n_words", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontaminate.judged(decontaminate.contamination(table, bench)).collect())
    want = Counter()
    for i, text in rows:
        w, hit, found = word.findall(lowered(text)), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (x := tuple(w[k : k + size])) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[x]
        want[(i, len(w), len(hit), tuple(sorted(found)))] += 1
    assert got == want
    assert decontaminate.clean(table.limit(0), bench).count() == 0
    assert decontaminate.clean(table, bench.limit(0)).count() == len(rows)
    named = bench.where("item_id < 20").select(F.concat(F.lit("item-"), F.col("item_id")).alias("item_id"), "text")
    got = {x for r in decontaminate.contamination(table, named).collect() for x in r["items"]}
    assert got == {f"item-{x}" for r in want for x in r[3] if x < 20} and got


def test_benchmark_in_parts(spark, docs, monkeypatch):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    columns = ["doc_id", "n_words", "hit_from", "hit_to", "items"]
    once = sorted(decontaminate.contamination(docs, bench).select(columns).collect())
    monkeypatch.setattr(decontaminate, "PART_PAIRS", 250)
    assert sorted(decontaminate.contamination(docs, bench).select(columns).collect()) == once


def test_token_records(spark, docs):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] + [(1000, None), (1001, "a  b \n c<|endoftext|> d "), (1002, ""), (1003, " x   y  z's'll 12,5")]
    start = 0
    want = []
    for i, text in sorted(rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
        start += len(ids)
    got = token_records.token_table(spark.createDataFrame(rows, SCHEMA), path("byte_bpe_50k.json"))
    assert sorted(tuple(r) for r in got.collect()) == want


def test_encoder_learns_words_of_lines_apart():
    """A word that ends a line and one that begins the next are learned once each, not once for every pair of them."""
    from public_tokenizers import path

    encoder = token_records.Encoder(path("byte_bpe_50k.json"))
    own, seen = encoder.tokenizer, []

    class Counted:
        def encode(self, text, **more):
            seen.append(text)
            return own.encode(text, **more)

        def encode_batch_fast(self, texts, **more):
            seen.extend(texts)
            return own.encode_batch_fast(texts, **more)

    texts = [f"so it {a}.\n{b}, then" for a in ("ends", "été", "x1", "stops") * 3 for b in ("Next", "The", "B2", "Über", "And") * 3]
    texts += ["a \nb c", "a\n b c", "a b\n\nc", "a b\n", "\na", "a b\nc\nd'\ns e", "x <|endoftext|>\ny", "a b\r\nc", "a b\x85\nc", "", " ", "a  b"]
    want = [np.array(own.encode(t, add_special_tokens=False).ids, dtype=encoder.kind).tobytes() for t in texts]
    encoder.tokenizer = Counted()
    for _ in range(2):
        assert encoder.encode(pa.array(texts)) == want
    assert not [t for t in seen if ".\n" in t and t.endswith(("Next,", "The,", "B2,"))]
    assert encoder.encode(pa.array([], pa.string())) == []


def test_record_files(spark, tmp_path):
    from public_tokenizers import path

    table = spark.createDataFrame([(i, "word " * i) for i in range(1, 9)], SCHEMA)
    token_records.write_records(table.repartition(1), path("byte_bpe_50k.json"), str(tmp_path / "r"))
    name = sorted(p.stem for p in (tmp_path / "r").glob("*.bin"))[0]
    whole = list(token_records.records_of((tmp_path / "r" / f"{name}.bin").read_bytes()))
    back = token_records.read_at(str(tmp_path / "r"), name, list(range(len(whole)))[::-1])
    assert [(i, x.tolist()) for i, x in back[::-1]] == [(i, x.tolist()) for i, x in whole]
    data = bytearray((tmp_path / "r" / f"{name}.bin").read_bytes())
    data[-6] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        list(token_records.records_of(bytes(data)))


def test_topk_odd(spark):
    rows = [(i, [float(i % 3), 1.0]) for i in range(50)] + [(60, None), (80, [None, 1.0]), (100, [float("nan"), 1.0]), (120, [1.0])]
    v = topk_search.whole_numbers(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = topk_search.top_k(v, v.where("vec_id % 20 = 0"), 5).collect()
    assert {r.query_id for r in got} == {0, 20, 40}
    best = sorted(r.vec_id for r in got if r.query_id == 20)
    assert best == [2, 5, 8, 11, 14]
    assert topk_search.top_k(v.limit(0), v.limit(0)).count() == 0


def test_mixing(spark, docs):
    got = mixing.mix(docs)
    rows = docs.select("doc_id", "source").join(got, "doc_id").collect()
    assert len(rows) == docs.count()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert r.taken in (0, r.size, 2 * r.size)
    total = sum(r.size for r in rows)
    weight = dict(zip(sorted(by), [3, 1, 2] * len(by), strict=False))
    want, capped = {}, set()
    while True:  # reshare until no target is above its cap
        left = 1.5 * total - sum(2 * by[s][0].source_size for s in capped)
        free = [s for s in by if s not in capped]
        want = {s: 2 * by[s][0].source_size for s in capped} | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        if not (above := {s for s in free if want[s] > 2 * by[s][0].source_size}):
            break
        capped |= above
    for s, own in by.items():
        assert math.isclose(own[0].target, want[s], rel_tol=1e-9)
        assert 0 <= own[0].target - sum(r.taken for r in own) <= max(r.size for r in own)
    assert sorted(mixing.mix(docs).collect()) == sorted(got.collect())
    assert mixing.mixed(docs).count() == sum(len(r.shards) for r in rows)


def test_splitting_tree_keeps_quotas(spark):
    quotas = spark.createDataFrame([("sa", 1000), ("sb", 7), ("n", 0), ("sc", 333)], "src string, blocks long")
    cells = mixing.splitting_tree(quotas, 7).collect()
    assert {s: sum(c.blocks for c in cells if c.src == s) for s in ("sa", "sb", "sc")} == {"sa": 1000, "sb": 7, "sc": 333}
    sizes = Counter()
    for c in cells:
        sizes[c.shard] += c.blocks
    assert max(sizes.values()) - min(sizes.values()) <= 3
    spans = sorted((c.begin, c.begin + c.blocks) for c in cells if c.src == "sa")
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_mixing_odd(spark):
    rows = mixing.mix(odd(spark)).collect()
    assert len(rows) == len(ODD) and all(r.taken <= 2 * r.size for r in rows)
    assert mixing.mix(odd(spark, [])).count() == 0


def test_sharding(spark, docs):
    limit = 20_000
    rows = sharding.sharded(docs, limit=limit).select("doc_id", "shard", "shard_bytes", "shard_rows", F.octet_length("text").alias("b")).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    sums, n = Counter(), Counter()
    for r in rows:
        sums[r.shard] += r.b
        n[r.shard] += 1
    assert all(sums[r.shard] == r.shard_bytes and n[r.shard] == r.shard_rows and (r.shard_bytes <= limit or r.shard_rows == 1) for r in rows)
    names = sorted(sums)
    assert not any(b.startswith(a) for a in names for b in names if a != b)
    for name in names:  # a bucket's parent was oversized
        assert not name or sum(v for k, v in sums.items() if k.startswith(name[:-1])) > limit


def test_sharding_of_equal_rows(spark):
    rows = sharding.sharded(odd(spark, [(1, "x" * 100)] * 50 + [(2, None)]), limit=1000).collect()
    assert len(rows) == 51
    assert all(r.shard_bytes <= 1000 for r in rows) and len({r.shard for r in rows if r.doc_id == 1}) == 5
    assert sharding.sharded(odd(spark, [])).count() == 0


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def test_pseudonyms(spark):
    texts = ["card 4111 1111 1111 1111, 4111111111111111 or 4111111111111112", "on 2024-02-29 and 29.02.2024, not 2023-02-29", "from 10.0.0.1 or 10.0.0.999", "ask Ann.Lee7@mail.example.com", "1 (017) 555-7713", "123-45-6789 and 000-12-3456", None, "", "nothing 12"]
    table = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    out = {r.doc_id: r for r in pseudonyms.pseudonymised(table, "k1").collect()}
    again = {r.doc_id: r.text for r in pseudonyms.pseudonymised(table, "k1").collect()}
    other = {r.doc_id: r.text for r in pseudonyms.pseudonymised(table, "k2").collect()}
    assert again == {i: r.text for i, r in out.items()} and other[0] != out[0].text
    first, second, third = re.findall(r"\d[\d ]{14,}\d", out[0].text)
    assert first.replace(" ", "") == second and luhn(second) and second != "4111111111111111" and third == "4111111111111112"
    days = re.findall(r"\d{4}-\d\d-\d\d", out[1].text)
    swapped = re.search(r"(\d\d)\.(\d\d)\.(\d{4})", out[1].text)
    assert days[0] == "-".join(swapped.groups()[::-1]) and days[1] == "2023-02-29" and days[0] != "2024-02-29"
    assert out[2].text.endswith("10.0.0.999") and all(int(x) < 256 for x in re.findall(r"\d+", out[2].text)[:4])
    assert re.fullmatch(r"ask [A-Z][a-z]{2}\.[A-Z][a-z]{2}\d@mail\.example\.com", out[3].text) and "Ann" not in out[3].text
    assert re.fullmatch(r"1 \(\d{3}\) \d{3}-\d{4}", out[4].text) and out[5].text.endswith("000-12-3456")
    assert (out[6].text, out[7].text, out[8].text) == (None, "", "nothing 12") and out[8].n_replaced == 0


def test_pseudonyms_are_one_to_one(spark):
    rows = spark.range(0, 3000).select(F.col("id").alias("doc_id"), F.date_format(F.expr("date_add(DATE'1990-01-01', cast(id as int))"), "yyyy-MM-dd").alias("text"))
    assert pseudonyms.pseudonymised(rows, "k").select("text").distinct().count() == 3000


def test_license_scan(spark):
    mit = license_scan.KNOWN["MIT"]
    texts = [mit, mit.upper().replace("<year> <copyright holders>", "2020 Some One").replace(",", " ;"), "prose\nReleased under the MIT Licence!\nmore", None, "", "...", mit + " more"]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(list(enumerate(texts)), SCHEMA), license_scan.known_table(spark)).collect()}
    assert [got[i].license for i in range(7)] == ["MIT", "MIT", None, None, None, None, None]
    assert got[2].notices == ["MIT notice"] and got[3].digest is None and got[5].digest is None
    assert got[0].digest == hashlib.sha256(license_scan_plain(spark, mit).encode()).hexdigest()


def license_scan_plain(spark, text):
    return spark.range(1).select(license_scan.canonical(F.lit(text)).alias("t")).first().t


def test_site_quality(spark, docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    train, held = labels.where("doc_id % 3 > 0"), {r.doc_id: r.quality for r in labels.where("doc_id % 3 = 0").collect()}
    got = {r.doc_id: r for r in site_quality.judged(docs, train, ["doc_id"]).collect()}
    right = sum(got[i].kept == bool(q) for i, q in held.items())
    assert len(got) == docs.count() and right >= 0.95 * len(held)
    assert all(0 < r.path_rate < 1 for r in got.values())


def test_site_quality_odd(spark):
    none = spark.createDataFrame([(1, None, 0)], "doc_id long, quality int, toxic int")
    rows = site_quality.judged(odd(spark), none, ["doc_id", "source"]).collect()
    assert len(rows) == len(ODD) and all(r.kept for r in rows)
    two = spark.createDataFrame([(7, 1, 0), (8, 0, 0), (8, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert site_quality.judged(odd(spark), two, ["doc_id"]).count() == len(ODD)


def test_full_license_texts(spark):
    """Whole licence texts under, without and beside their titles; Spark's digest of each spelling is the stored one."""
    where = license_scan.files("martloom.llm").joinpath("licenses")
    parts = {f.name.removesuffix(".txt"): f.read_text(encoding="utf-8").split("\n%%\n") for f in where.iterdir()}
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense", "CC0-1.0", "CC-BY-SA-4.0"} <= set(parts)
    texts = []
    for name, (titles, body, appendix) in parts.items():
        first = titles.split("\n%\n")[0]
        texts += [(name, f"{first}\n\n{body}\n{appendix}"), (name, f"Copyright (c) 2020 Some One\n\n{body}"), (name, f"{first}\n{body}".replace("http://", "https://").upper())]
    mit, isc, zlib_ = (license_scan.KNOWN[x] for x in ("MIT", "ISC", "Zlib"))
    texts += [("MIT", mit.split("\n", 1)[1]), ("MIT", "The " + mit), ("ISC", isc.split("\n", 1)[1]), ("ISC", isc.replace("and/or dist", "and dist")), ("Zlib", zlib_.split("\n", 1)[1])]
    two = parts["BSD-2-Clause"][1]
    texts += [("BSD-2-Clause", two.replace("1. ", "* ").replace("2. ", "* ")), ("Apache-2.0", parts["Apache-2.0"][1].replace("authorized", "authorised"))]
    table = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.license for r in license_scan.scan(table, license_scan.known_table(spark)).collect()}
    assert [(n, got[i]) for i, (n, _) in enumerate(texts) if got[i] != n] == []
    notices = ["// SPDX-License-Identifier: BSD-3-Clause", "This project is licensed under the Mozilla Public License 2.0.", "Released under the MIT License."]
    row = license_scan.scan(spark.createDataFrame([(1, "code\n" + "\n".join(notices) + "\nmore")], SCHEMA), license_scan.known_table(spark)).first()
    assert row.license is None and row.notices == ["BSD-3-Clause", "MIT notice", "MPL-2.0"]


@pytest.mark.parametrize("others", [40, 2000])
def test_topk_of_repeated_queries(spark, others):
    """A query's repeated rows take no place of another vector, in a small block and in one left open after the stretches."""
    x = {i: [i, others - i, i * 37 % others] for i in range(1, others)}
    rows = [(i, [float(c) for c in v]) for i, v in x.items()] + [(0, [2000.0, 2000.0, 20.0])] * 3
    v = topk_search.whole_numbers(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = sorted(topk_search.top_k(v, v.where("vec_id = 0"), 20).collect(), key=lambda r: r["rank"])
    want = sorted((-64 * 64 * (2000 * (a + b) + 20 * c), i) for i, (a, b, c) in x.items())[:20]
    assert [(r["rank"], -r.score, r.vec_id) for r in got] == [(n + 1, *w) for n, w in enumerate(want)]


def test_mixing_beside_huge_documents(spark):
    """Room that a huge document in the crossing block leaves goes to later blocks: in the end no document left fits."""
    huge = [(10_000 + i, "w " * 3_000, "abcd"[i % 4]) for i in range(24)]
    small = [(i, "w " * (20 + i % 97), "abcd"[i % 4]) for i in range(1200)]
    table = spark.createDataFrame(huge + small, "doc_id long, text string, source string")
    rows = table.select("doc_id", "source").join(mixing.mix(table, block_words=100), "doc_id").collect()
    assert len(rows) == len(huge) + len(small)
    for s in "abcd":
        own = [r for r in rows if r.source == s]
        left, passes = own[0].target - sum(r.taken for r in own), int(own[0].target / own[0].source_size)
        assert 0 <= left < min((r.size for r in own if len(r.shards) <= passes), default=1)


def test_pseudonyms_of_other_shapes(spark):
    """Printed groupings of payment numbers, dotted, spaced and international phones, and IBANs."""
    texts = ["3782 822463 10005", "378282246310005", "3056-930902-5904", "30569309025904", "555.123.4567", "555 123 4567", "(555)123-4567", "+1 (555) 123-4567", "+15551234567", "+44 20 7946 0958", "+442079460958", "DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32 2024", "DE88370400440532013000"]
    rows = pseudonyms.pseudonymised(spark.createDataFrame([(i, f"see {t} now") for i, t in enumerate(texts)], SCHEMA), "k1").collect()
    out = {r.doc_id: r.text.removeprefix("see ").removesuffix(" now") for r in rows}
    plain = {i: re.sub(r"[^0-9A-Z]", "", t) for i, t in out.items()}
    assert out[14] == texts[14] and all(out[i] != texts[i] for i in range(14))
    assert all(re.sub(r"[0-9]", "0", out[i]) == re.sub(r"[0-9]", "0", texts[i]) for i in range(13))
    assert plain[0] == plain[1] and plain[2] == plain[3] and luhn(plain[0]) and luhn(plain[2])
    assert plain[4] == plain[5] == plain[6] == plain[7][1:] == plain[8][1:] and plain[9] == plain[10] and plain[11] == plain[12]
    for iban in (plain[12], plain[13].removesuffix("2024")):
        assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert re.fullmatch(r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d 2024", out[13])


def test_copies_go_to_shards_at_random(spark):
    """The two draws of a block fall into one shard as often as chance has it, whatever the number of a source's blocks."""
    names = [f"s{i}" for i in range(24)]
    table = spark.range(24 * 400).select(F.col("id").alias("doc_id"), F.lit("w " * 30).alias("text"), F.concat(F.lit("s"), F.col("id") % 24).alias("source"))
    rows = table.select("doc_id", "source").join(mixing.mix(table, weights=(1,), share=2.0, shards=16, block_words=100), "doc_id").collect()
    share = {n: [len(set(r.shards)) == 1 for r in rows if r.source == n and len(r.shards) == 2] for n in names}
    assert all(len(x) == 400 for x in share.values())
    assert all(sum(x) / len(x) < 0.2 for x in share.values())
    assert 0.03 < sum(map(sum, share.values())) / len(rows) < 0.1  # 1 in 16


def test_shards_grow_with_words(spark, monkeypatch):
    table = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("w " * 10).alias("text"), F.lit("s").alias("source"))
    monkeypatch.setattr(mixing, "SHARD_WORDS", 50)
    monkeypatch.setattr(mixing, "SHARDS", 2)
    assert mixing.mixed(table, block_words=20).rdd.getNumPartitions() == 60


def test_topk_ends_by_its_bounds():
    """Few long vectors among many short ones: queries end after the first stretches; uniform ones read further; both are exact."""
    rng = np.random.default_rng(2)
    n, k = 4000, 20
    steep = rng.integers(1, 5, (n, 8))
    steep[rng.choice(n, 60, replace=False)] *= 200
    flat = rng.integers(-200, 201, (n, 64))
    for x, low, least in ((steep, 1, 0.9), (flat, -50, 0.0)):
        q = rng.integers(low, 51, (100, x.shape[1]))
        block = topk_search.Block(np.arange(n), x, topk_search._kind(x, q))
        found = block.search(np.arange(10_000, 10_100), q, k)
        for row, (ids, scores) in zip(q, found, strict=True):
            every = x @ row
            want = np.lexsort((np.arange(n), -every))[:k]
            assert ids.tolist() == want.tolist() and scores.tolist() == every[want].tolist()
        assert sum(block.ended) == 100 and sum(block.ended[:2]) >= 100 * least and block.rows <= 100 * n * len(topk_search.STRETCHES)


def test_topk_scores_beyond_64_bits(spark):
    v = spark.createDataFrame([(0, [1 << 40]), (1, [1 << 30])], "vec_id long, v array<long>")
    with pytest.raises(Exception, match="64 bits"):
        topk_search.top_k(v, v).collect()
