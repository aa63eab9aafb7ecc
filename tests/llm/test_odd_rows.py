"""Plain-Python versions of pseudonyms, licence digests and URL rules, and odd rows of all earlier operators."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from datetime import date, timedelta

import pytest
import regex
from conftest import SMALL
from pyspark.sql import functions as F

from martloom.llm import license_scan, mixing, ngram_join, pseudonyms, sharding, site_quality, token_records, url_filter

SCHEMA = "doc_id long, text string"
LONG = "word " * 200_000
TEXTS = [(1, "a b c d e f"), (1, "a b c d e f"), (2, None), (2, ""), (None, "g h i j k l"), (None, None), (7, LONG)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def odd(spark, **more):
    """Odd rows, with columns named as those that operators make."""
    rows = spark.createDataFrame(TEXTS, SCHEMA).withColumns({"source": F.lit(None).cast("string"), "lang": F.lit(None).cast("string")})
    return rows.withColumns({c: F.lit(v) for c, v in more.items()})


# Pseudonyms


def noise(key, turn, other, place=0):
    return int(hashlib.sha256(f"{key}|{turn}|{other}|{place}".encode()).hexdigest()[:8], 16)


def permuted(key, number, left, right):
    a, b = divmod(number, right)
    for turn in range(6):
        if turn % 2:
            a = (a + noise(key, turn, b)) % left
        else:
            b = (b + noise(key, turn, a)) % right
    return a * right + b


def moved(key, text):
    half = [text[: len(text) // 2], text[len(text) // 2 :]]
    for turn in range(6):
        mine, other = (1, 0) if turn % 2 == 0 else (0, 1)
        new = ""
        for i, c in enumerate(half[mine]):
            by = noise(key, turn, half[other], i)
            for first, count in (("0", 10), ("a", 26), ("A", 26)):
                if ord(first) <= ord(c) < ord(first) + count:
                    c = chr(ord(first) + (ord(c) - ord(first) + by) % count)
                    break
            new += c
        half[mine] = new
    return half[0] + half[1]


def laid(text, digits):
    left = iter(digits)
    return re.sub(r"\d", lambda _: next(left), text)


def with_check_digit(body):
    total = sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(body)))
    return body + str(-total % 10)


def social_number(key, text):
    area, group, serial = map(int, text.split("-"))
    areas = [a for a in range(1, 900) if a != 666]
    v = permuted(key, (areas.index(area) * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999)
    return f"{areas[v // 989901]:03}-{v // 9999 % 99 + 1:02}-{v % 9999 + 1:04}"


def other_day(key, text):
    """Another day of the same 400 years, counted from 1600."""
    start = date(1600, 1, 1)
    era, day = divmod((date.fromisoformat(text) - start).days, 189 * 773)
    return str(start + timedelta(days=era * 189 * 773 + permuted(key, day, 189, 773)))


def other_address(key, text):
    v = permuted(key, int.from_bytes(map(int, text.split("."))), 1 << 16, 1 << 16)
    return ".".join(map(str, v.to_bytes(4)))


def other_card(key, text):
    return laid(text, with_check_digit(moved(key, re.sub(r"\D", "", text)[:-1])))


def other_mail(key, text):
    name, host = text.split("@")
    return f"{moved(key, name)}@{host}"


def test_pseudonyms_by_a_plain_network(spark):
    socials = [f"{a:03}-{g:02}-{s:04}" for a, g, s in ((1, 1, 1), (899, 99, 9999), (665, 99, 9999), (667, 1, 1), (123, 45, 6789), (400, 10, 77))]
    days = ["2024-02-29", "1600-01-01", "1999-12-31", "1970-01-01"]
    cards = [with_check_digit(b) for b in ("411111111111111", "37828224631000", "601100099013942")] + ["4111 1111 1111 1111", "4111-1111-1111-1111"]
    addresses = ["10.0.0.1", "255.255.255.255", "0.0.0.0"]
    mails = ["Ann.Lee7@mail.example.com", "x@a.org", "a_b+C9@b.net"]
    want = [(t, f("k9", t)) for f, texts in ((social_number, socials), (other_day, days), (other_card, cards), (other_address, addresses), (other_mail, mails)) for t in texts]
    table = spark.createDataFrame([(i, f"see {t} now") for i, (t, _) in enumerate(want)], SCHEMA)
    got = {r.doc_id: r.text for r in pseudonyms.pseudonymised(table, "k9").collect()}
    assert [got[i] for i in range(len(want))] == [f"see {new} now" for _, new in want]


def test_social_numbers_stay_valid(spark):
    rows = [(i, f"{i % 664 + 1:03}-{i % 99 + 1:02}-{i % 9999 + 1:04}") for i in range(2000)]
    out = [r.text for r in pseudonyms.pseudonymised(spark.createDataFrame(rows, SCHEMA), "k").collect()]
    assert len(set(out)) == 2000
    assert all(re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", t) for t in out)


def test_pseudonyms_odd(spark):
    rows = pseudonyms.pseudonymised(odd(spark, n_replaced="clash"), "k").collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(TEXTS) and all(r.n_replaced == 0 for r in rows)
    long = pseudonyms.pseudonymised(spark.createDataFrame([(1, LONG + "123-45-6789 " * 2), (1, LONG + "123-45-6789 " * 2)], SCHEMA), "k").collect()
    assert long[0] == long[1] and long[0].n_replaced == 2 and long[0].text.startswith(LONG)
    assert pseudonyms.pseudonymised(odd(spark).limit(0), "k").count() == 0


# Licences


def canonical(text):
    """Lower case, copyright lines out, one space for all that is neither letter nor digit, equivalent spellings."""
    kept = []
    for line in text.lower().split("\n"):
        bare = regex.sub(r"^[^\p{L}\p{N}©(]*", "", line)
        claim = regex.match(r"\(?copyright\b([^\p{L}]*\b(c|by)\b|[^\p{L}]*\d|\s*[(<©])|\(c\)\s|©|all rights reserved", bare)
        kept.append("" if claim else line)
    words = regex.sub(r"[^\p{L}\p{N}]+", " ", "\n".join(kept)).strip()
    for one, usual in license_scan.EQUIVALENT:
        words = words.replace(one, usual)
    return words


def test_digests_by_a_plain_canonical_text(spark, docs):
    texts = ["Copyright (c) 2020 Some One\nThe Licence, v. 2", "© 2021 x\nfoo", "* Copyright 2020 by A\n * bar_baz", "copyright holder of it", "(c) me\n", "All rights reserved.\nA  B\n\nC", "Ünï — Çode", "favour\nfulfil it"]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] + [(10_000_000 + i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r.digest for r in license_scan.scan(spark.createDataFrame(rows, SCHEMA), license_scan.known_table(spark)).collect()}
    want = {i: hashlib.sha256(c.encode()).hexdigest() if (c := canonical(t or "")) else None for i, t in rows}
    assert got == want


def test_license_scan_odd(spark):
    known = license_scan.known_table(spark, {"short": "a b c d e f", "long": LONG})
    rows = license_scan.scan(odd(spark, digest="clash", license="clash", notices="clash"), known).collect()
    assert Counter((r.doc_id, r.license) for r in rows) == Counter({(1, "short"): 1, (2, None): 2, (None, None): 2, (7, "long"): 1})
    assert license_scan.scan(odd(spark).limit(0), known).count() == 0


# URL rules


def judged(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if ("." + host).endswith("." + h) and path.startswith(p)] if url is not None else []
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_url_rules_odd(spark, monkeypatch):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("net", "", "block")]
    urls = ["https://Sub.Example.org/es/x?y", "http://example.org/es", "HTTP://EXAMPLE.ORG/en/12#a", "https://badexample.org/es/", "x.com/de/", "a://b.com/de/://c.org/", "https://b.com?/de/", "https://b.com/de/#", "://org/", "https:///org/", "", None, "s://ünï.COM/de/é", "s://x.net", "s://net", "s://x.net.", "s://b.com/de/\n/x", "s://b.com/DE/", "s://" + "a." * 3000 + "com/fr/" + "x" * 50_000]
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls + urls)], "page_id long, url string, host string, verdict string")
    for size in (url_filter.SENT_BYTES, 0):
        monkeypatch.setattr(url_filter, "SENT_BYTES", size)
        got = {r.page_id: (r.host, r.path, r["rule"], r.verdict) for r in url_filter.judged(pages, url_filter.rule_table(spark, rules)).collect()}
        assert got == {i: judged(u, rules) for i, u in enumerate(urls + urls)}
    assert url_filter.judged(pages.limit(0), url_filter.rule_table(spark, rules)).count() == 0
    none = url_filter.rule_table(spark, rules).limit(0)
    assert {(r["rule"], r.verdict) for r in url_filter.judged(pages, none).collect()} == {(None, "allow")}


# The others


def test_sharding_odd(spark):
    table = odd(spark, shard="clash", shard_rows=9).withColumn("m", F.create_map(F.lit("a"), F.col("doc_id")))
    rows = sharding.sharded(table, limit=1000).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(TEXTS)
    assert all(r.shard_bytes <= 1000 or r.shard_rows == 1 for r in rows) and all(re.fullmatch(r"[01]*(\+\d+)?", r.shard) for r in rows)
    assert sharding.sharded(table.limit(0)).count() == 0


def test_near_duplicates_with_clashing_columns(spark):
    table = odd(spark, component_id=5, n=6, k1=7, text_hash=8, _id=9)
    rows = ngram_join.one_of_each(table).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter([(1, "a b c d e f"), (2, None), (2, ""), (None, "g h i j k l"), (None, None), (7, LONG)])
    assert set(rows[0].asDict()) == set(table.columns) and {r.component_id for r in rows} == {5}


def test_mix_with_clashing_columns(spark, docs):
    table = docs.withColumns({c: F.lit("clash") for c in ("size", "key", "block", "shard", "src", "row")})
    rows = mixing.mixed(table)
    assert rows.columns == table.columns and rows.count() == mixing.mixed(docs).count()
    assert mixing.mixed(table.limit(0)).count() == 0


def test_site_quality_with_clashing_columns(spark, docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    names = ["doc_id", "p", "host", "path", "row", "n", "_host"]
    table = docs.withColumns({c: F.lit("clash") for c in names[1:]})
    rows = site_quality.judged(table, labels, names)
    plain = {r.doc_id: r.posterior for r in site_quality.judged(docs, labels, ["doc_id"]).collect()}
    got = rows.collect()
    assert {r.doc_id: round(r.posterior, 9) for r in got} == {i: round(p, 9) for i, p in plain.items()} and {r.p for r in got} == {"clash"}
    assert site_quality.judged(table.limit(0), labels, names).count() == 0
    assert site_quality.good(table, labels).columns == table.columns


def test_token_records_odd(spark):
    from public_tokenizers import path

    rows = token_records.token_table(odd(spark, start=1, n_tokens=2, task=3), path("byte_bpe_50k.json")).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in TEXTS)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order == [None, None, 1, 1, 2, 2, 7]
    assert token_records.token_table(odd(spark).limit(0), path("byte_bpe_50k.json")).count() == 0
