"""URL rules without their index, context on both sides, limits between lengths, one-line licences, tasks of a read-back."""

import collections
import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from recfold.llm import license_digest, pii, queries, token_lengths, url_rules, warc_zip

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_judge(url, hosts, patterns):
    """Every rule on the URL, one by one."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    place = re.split("[?#]", rest, maxsplit=1)[0]
    host, slash, path = place.partition("/")
    host, path = host.translate(UPPER), slash + path
    if not host:
        return host, path, None, "allow", None
    fits = [(-len(name), verdict != "block", name, verdict) for verdict, name in hosts
            if ("." + host).endswith("." + name.partition("/")[0]) and path.startswith("/" + name.partition("/")[2])]
    if fits:
        return host, path, min(fits)[2], min(fits)[3], None
    place = (host + path).translate(UPPER)
    for verdict, name in patterns:
        signs = {"^": r"(?:[^a-z0-9]+|\A|\Z)", "*": ".*"}
        if re.search("".join(signs.get(c) or re.escape(c) for c in name.translate(UPPER)), place, re.S):
            fits.append((-len(name), verdict != "block", name, verdict))
    return (host, path, None, min(fits)[3], min(fits)[2]) if fits else (host, path, None, "allow", None)


def drawn_urls(draw, words, number):
    signs = list("./-_=*^$+(\\é") + ["//", ""]
    urls = []
    for _ in range(number):
        host = ".".join("".join(draw.choices(words, k=draw.randint(1, 2))) for _ in range(draw.randint(1, 3)))
        path = "".join(draw.choice(words) + draw.choice(signs) for _ in range(draw.randint(0, 4)))
        urls.append(f"http{draw.choice(['', 's'])}://{host}{draw.choice(['', '/'])}{'/' + path if path else ''}{draw.choice(['', '?casino', '#x'])}")
    return [*urls, None, "", "casino.net/", "://", "x://", "x:///casino/", "x://CASINO.net/EN", "a\n://casino.net/\ncasino"]


def test_registered_rules_against_every_rule_on_every_url(spark):
    draw = random.Random(1)
    words = ["casino", "online", "poker", "a", "org", "com", "example", "fr", "de", "es", "en", "1", "ads", "Banner", "click",
             "wp-login.php", "lottery", "law", "track", "x.gif", "tag", "xxx", "law", "robots.txt", "ad-banner"]
    urls = drawn_urls(draw, words, 1500)
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("token", F.lit("clash"))
    got = {r.page_id: tuple(r)[1:] for r in url_rules.judge(pages.repartition(4)).collect()}
    want = {n: plain_judge(url, url_rules.HOST_RULES, url_rules.PATTERN_RULES) for n, url in enumerate(urls)}
    assert got == want
    assert {rule for *_, rule in want.values()} >= {"^casino^", "casino^", "^casino", "^lottery^*^law^", "^wp-login.php^"}
    oracle = duckdb.connect()
    oracle.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    oracle.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(urls)))
    assert {r[0]: r[1:] for r in oracle.execute(queries.SQL["op4_url_rules"]).fetchall()} == want


def test_no_rule_is_lost_through_its_tokens(spark):
    """A table of drawn rules, with and without tokens, with signs that expressions know."""
    draw = random.Random(3)
    words = ["ab", "b", "ca", "a1", "É", "ab-b"]
    pieces = [*words, "^", "*", ".", "/", "$", "(", "\\", "+", "-"]
    patterns = {(draw.choice(["block", "allow"]), "".join(draw.choices(pieces, k=draw.randint(1, 6)))) for _ in range(250)}
    hosts = {("block", f"{draw.choice(words).lower()}.{draw.choice(['b', 'ca'])}/{draw.choice(['', 'ab', 'ab/', 'b/A1'])}") for _ in range(20)}
    hosts = {(v, n) for v, n in hosts if "É" not in n}
    urls = drawn_urls(draw, words, 400)
    rules = url_rules.listed_rules(spark, sorted(hosts), sorted(patterns)).union(
        url_rules.listed_rules(spark, sorted(hosts)[:3], sorted(patterns)[:3]))
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: tuple(r)[1:] for r in url_rules.judge(pages, rules).collect()}
    assert got == {n: plain_judge(url, hosts, patterns) for n, url in enumerate(urls)}
    tokens = {r.name: r.tokens for r in url_rules.compiled(rules).collect()}
    assert any(not t for t in tokens.values()) and any(t for t in tokens.values())


def test_no_rules_and_no_pages(spark):
    rules = url_rules.listed_rules(spark)
    pages = spark.createDataFrame([(1, "http://casino.net/"), (1, "http://casino.net/"), (None, None)], "page_id long, url string")
    assert {r.verdict for r in url_rules.judge(pages, rules.limit(0)).collect()} == {"allow"}
    assert [r.verdict for r in url_rules.judge(pages, rules).orderBy("page_id").collect()] == ["allow", "block", "block"]
    assert url_rules.judge(pages.limit(0), rules).count() == 0


def test_context_on_either_side_counts(spark):
    texts = ["123-45-6789 (SSN)", "phone 555-123-4567, 555-123-4568", "555-123-4567", "x" * 50 + " 555-123-4567 " + "y" * 50 + " phone",
             "555-123-4567 " + "y " * 15 + "phone", "555-123-4567 555-123-4568 555-123-4569 call", None, "", "555-123-4567 phones"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [s.found for s in r.pii_spans] for r in pii.find_spans(df).collect()}
    numbers = [f"555-123-456{n}" for n in (7, 8, 9)]
    assert got == {0: ["123-45-6789"], 1: numbers[:2], 2: [], 3: [], 4: numbers[:1], 5: numbers, 6: [], 7: [], 8: []}


def test_limits_between_lengths(spark):
    draw = random.Random(2)
    lengths = [draw.choice((0, 1, 5, 4095, 4096, 4097, 9000, 20_000, 70_000)) for _ in range(200)]
    counts = spark.createDataFrame(collections.Counter(lengths).items(), "n_tokens long, n_docs long")
    sums = token_lengths.suffix_sums(counts)
    limits = [-3, 0, 1, 2, 4, 5, 4094, 4095, 4096, 4098, 8999, 9000, 12_287, 12_288, 19_999, 20_000, 69_999, 70_000, 10**9]
    df = spark.createDataFrame([(n,) for n in [*limits, None, 5, 5]], "limit long")
    got = {r.limit: (r.docs_cut, r.total_tokens) for r in token_lengths.at_limits(sums, df).collect()}
    assert got == {m: (sum(n > max(m, 0) for n in lengths), sum(min(n, max(m, 0)) for n in lengths)) for m in limits}
    none = token_lengths.at_limits(token_lengths.suffix_sums(counts.limit(0)), df).collect()
    assert {r.limit for r in none} == set(limits) and {(r.docs_cut, r.total_tokens) for r in none} == {(0, 0)}
    assert token_lengths.at_limits(sums, df.limit(0)).count() == 0
    assert token_lengths.at_quantiles(sums, [0.5, 0.5, 2.0]).count() == 1


def test_licences_on_one_line_with_their_copyright(spark):
    mit = license_digest.KNOWN[6][1]
    texts = ["Copyright (c) 2020 X " + mit, "(c) 2019 A, B. All rights reserved. " + mit, "Copyright 2020 X. Released under the MIT License.",
             "Copyright (c) 2020 nobody", "© 1 X\n" + mit, "x Copyright (c) 2020 " + mit, "Copyright 2020 X " + mit + " more"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.license for r in license_digest.scan(df, license_digest.known_digests(spark)).collect()}
    assert got == {0: "MIT", 1: "MIT", 2: "MIT", 3: None, 4: "MIT", 5: None, 6: None}
    oracle = duckdb.connect()
    oracle.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    oracle.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    assert {r[0]: r[1] for r in oracle.execute(queries.SQL["op8_license_digests"]).fetchall()} == got


def test_read_back_takes_as_many_tasks_as_the_records_ask_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc_zip, "_TASK_BYTES", 20_000)
    draw = random.Random(4)
    pages = [(n, "http://a/", "".join(draw.choices("abcdefghij <>", k=3000))) for n in range(200)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    packages = warc_zip.write_packages(df, f"file://{tmp_path}/p", package_bytes=100_000)
    read = warc_zip.read_records(warc_zip.locate(packages))
    tasks = read.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 4 and sum(r["count"] for r in tasks) == 200
    assert {(r.page_id, r.payload.decode()) for r in read.collect()} == {(n, html) for n, _, html in pages}
    assert warc_zip.read_records(warc_zip.locate(packages).limit(0)).count() == 0


@pytest.mark.parametrize("empty", [True, False])
def test_archives_of_awkward_pages(spark, tmp_path, empty):
    """Very long pages, NULLs, columns of clashing names, and no pages at all."""
    rows = [] if empty else [(1, None, None), (2, "u", "é" * 3_000_000), (3, "u", "é" * 3_000_000), (None, "u", "x" * 200), (4, "u", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.selectExpr("*", "'clash' AS digest", "'clash' AS package", "1 AS begin", "'clash' AS refers_to")
    packages = warc_zip.write_packages(df, f"file://{tmp_path}/p")
    read = warc_zip.read_records(warc_zip.locate(packages)).collect()
    digest = lambda html: hashlib.sha256((html or "").encode()).hexdigest()
    assert collections.Counter((r.page_id, r.payload_digest) for r in read) == collections.Counter((n, digest(h)) for n, _, h in rows)
    assert all(hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in read if r.record_type == "response")
    assert {r.page_id: r.refers_to for r in read if r.record_type == "revisit"} == ({} if empty else {3: 2})
