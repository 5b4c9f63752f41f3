"""The corpus operators against brute force, on small tables that hold the awkward cases."""

import collections
import hashlib
import io
import itertools
import pathlib
import random
import re
import struct
import zipfile

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from recfold.llm import (
    bpe, components, decontaminate, license_digest, ngram_rules, pii, pu_quality, queries, simhash, token_lengths,
    url_rules, warc_zip,
)
from recfold.llm.rows import ID

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tiny(spark):
    """Documents with NULLs, repeats, ties, empty and long texts, and columns of clashing names."""
    draw = random.Random(3)
    words = ["of", "the", "Thon", "ered", "ción", "é", "a1", "x@y.org", "10.0.0.1", "4111111111111111", "###"]
    texts = [" ".join(draw.choices(words, k=draw.randint(0, 90))) for _ in range(40)]
    texts += [None, None, "", "   ", "\n", "one", "one two", texts[0], texts[0], texts[1] + " x", "a" * 20_000, "の " * 500]
    texts += ["line\n" * 60, ("the same words again " * 40), "12" * 9_000, "a@" + "b." * 9_000, "+" + "(" * 9_000]
    rows = [(n, t, "en", "s", len(t or "")) for n, t in enumerate(texts)]
    rows += [rows[0], (None, texts[2], None, None, None), (None, None, None, None, None), (7, "other text", "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = ("score", "fp", "pii_spans", "token_ids", "__recfold", "digest", "kept")
    return df.withColumns({name: F.lit("clash") for name in names}).cache()


def collected(tiny):
    return [(r.doc_id, r.text) for r in tiny.collect()]


def fingerprint(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    pieces = [" ".join(words[n:n + 3]) for n in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in pieces]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def classes(marks, radius):
    root = list(range(len(marks)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in itertools.combinations(range(len(marks)), 2):
        if (marks[a] ^ marks[b]).bit_count() <= radius:
            root[find(b)] = find(a)
    return [find(n) for n in range(len(marks))]


def test_simhash_groups(tiny):
    rows = collected(tiny)
    marks = [fingerprint(text) for _, text in rows]
    root = classes(marks, 3)
    low = {r: min((i for (i, _), q in zip(rows, root) if q == r and i is not None), default=None) for r in root}
    found = simhash.simhash_components(tiny).select(
        F.when(F.col(ID) != -(1 << 63), F.col(ID)), F.hex("fp"), "component_id").collect()
    want = [(i, f"{m:X}", low[r]) for (i, _), m, r in zip(rows, marks, root)]
    assert collections.Counter(map(tuple, found)) == collections.Counter(want)
    kept = simhash.one_of_each(tiny)
    assert kept.columns == tiny.columns and kept.count() == len(set(root))


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_sliced_comparison(radius):
    draw = random.Random(radius)
    base = [draw.getrandbits(64) for _ in range(40)]
    marks = np.array(sorted({b ^ sum(1 << draw.randrange(64) for _ in range(draw.randint(0, 5))) & (1 << 64) - 1
                             for b in base * 6}), np.uint64)
    a, b = simhash.bucket_links(np.zeros(len(marks), np.int64), marks, radius)
    got = dict(zip(a.tolist(), b.tolist()))
    root = classes(marks.tolist(), radius)
    groups = collections.Counter(root)
    assert len(marks) - len(got) == len(groups)
    where = dict(zip(marks.tolist(), root))
    assert all(where[x] == where[y] for x, y in got.items())


def test_large_buckets_are_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "_TILE", 16)
    marks = spark.range(200).select((F.col("id") * 5).alias("fp"))
    roots = components.connected_components(simhash.fingerprint_links(marks))
    assert roots.select("root").distinct().count() == len(set(classes([5 * n for n in range(200)], 3)))


def test_components_of_a_chain_and_a_hub(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    hub = spark.range(1000, 1400).select(F.lit(999).cast("long").alias("a"), F.col("id").alias("b"))
    roots = components.connected_components(chain.union(hub).union(hub))
    assert roots.count() == 301 + 401 and roots.select("root").distinct().count() == 2
    assert components.connected_components(chain.limit(0)).isEmpty()


def test_the_long_masks_alone_hit_windows_of_seventeen_to_twenty_tokens():
    masks = decontaminate._OFFSETS[:len(decontaminate.MASKS)]
    for size in range(decontaminate.SHORT, decontaminate.WINDOW + 1):
        wrong = size - int(np.ceil(decontaminate.SHARE * size))
        for changed in itertools.combinations(range(size), wrong):
            same = [n not in changed for n in range(size)]
            assert any(all(same[at + n] for n in offsets) for offsets in masks for at in range(size - offsets[-1])), changed


@pytest.mark.parametrize("size", range(decontaminate.LEAST, decontaminate.WINDOW + 1))
def test_masks_hit_every_length(size):
    offsets = decontaminate._OFFSETS if size < decontaminate.SHORT else decontaminate._OFFSETS[:len(decontaminate.MASKS)]
    wrong = size - int(np.ceil(decontaminate.SHARE * size))
    for changed in itertools.combinations(range(size), wrong):
        same = [n not in changed for n in range(size)]
        assert any(all(same[at + n] for n in mask) for mask in offsets for at in range(size - mask[-1])), changed


def test_short_items_with_substitutions(spark):
    """Places of substitutions that the three masks for 20 tokens do not hit."""
    wrong = {8: (1,), 9: (4,), 10: (2, 6), 11: (3, 7), 12: (3, 8), 15: (3, 7, 11), 16: (3, 7, 12)}
    items = {n: [f"i{n}x{k}" for k in range(n)] for n in wrong}
    bench = spark.createDataFrame([(n, " ".join(t)) for n, t in items.items()], "item_id long, text string")
    docs, want = [], set()
    for n, item in items.items():
        for changed in [*itertools.combinations(range(n), len(wrong[n]))][:: 1 if n < 15 else 7] + [wrong[n]]:
            copy = ["other" if k in changed else t for k, t in enumerate(item)]
            want.add((len(docs), n))
            docs.append((len(docs), " ".join(["before", *copy, "after"])))
        too_many = {*wrong[n], n - 1}
        docs.append((len(docs), " ".join("other" if k in too_many else t for k, t in enumerate(item))))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {(r[ID], r.item_id) for r in decontaminate.overlaps(df, bench).collect()} == want


def test_decontamination(spark):
    draw = random.Random(5)
    word = lambda: "".join(draw.choices("abcdefgh", k=4))
    items = [[word() for _ in range(n)] for n in (40, 25, 14, 8, 5)]
    items.append(list(items[0]))
    bench = spark.createDataFrame([(n, " ".join(t).upper()) for n, t in enumerate(items)] + [(9, None), (10, "")],
                                  "item_id long, text string")
    docs, want = [(0, None), (1, ""), (2, " ".join(items[4]))], {(2, 4)}  # an item of five tokens, whole
    for number in range(3, 60):
        text = [word() for _ in range(draw.randint(0, 80))]
        if number % 2:
            item = number % 3
            copy = list(items[item])
            size = min(20, len(copy))
            for place in draw.sample(range(size), size // 5 if item < 2 else 1):
                copy[place] = word()
            at = draw.randint(0, len(text))
            text[at:at] = copy[:size]
            want.add((number, item))
        docs.append((number, ", ".join(text)))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("seed", F.lit(1))
    found = decontaminate.overlaps(df, bench)
    assert {(r[ID], r.item_id) for r in found.collect()} == want
    assert {r.n_items for r in found.filter("item_id = 0").collect()} == {2}
    kept = {r.doc_id for r in decontaminate.without_benchmark(df, bench).collect()}
    assert kept == {n for n, _ in docs} - {n for n, _ in want}
    assert decontaminate.overlaps(df, bench.limit(0)).isEmpty() and decontaminate.overlaps(df.limit(0), bench).isEmpty()


def luhn(digits):
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def base_spans(text):
    bare = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(bare(m)) <= 19 and luhn(bare(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(bare(m)) <= 15),
    ]
    found = [(m.start(), rank, m.end(), name) for rank, (name, pattern, fits) in enumerate(kinds)
             for m in re.finditer(pattern, text) if fits(m.group())]
    return ",".join(f"{name}:{a}:{b}" for a, _, b, name in sorted(found))


def test_personal_data(spark):
    draw = random.Random(11)
    parts = ["a@b.c", "x.y@z-1.org", "_d@e.f", "@", ".", "1.2.3.4", "300.1.1.1", "001.02.3.255", "4111 1111-1111 1111",
             "4111111111111112", "+1 (017) 555-7713", "+49", "(", " ", "é", "😀", "7", "-", "+", "\n", "word"]
    texts = ["".join(draw.choices(parts, k=draw.randint(1, 14))) for _ in range(600)]
    texts += ["1" * 20_000, "9-" * 8_000, "a@" + "b." * 9_000, "a" * 20_000, "+1" + "(" * 9_000, "", "1." * 9_000]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)] + [(None, None)], "doc_id long, text string")
    rows = pii.find_spans(df).select("doc_id", pii.as_text(F.col("pii_base")).alias("base")).collect()
    assert {r.doc_id: r.base for r in rows} == {n: base_spans(t) for n, t in enumerate(texts)} | {None: ""}


def test_checksums_context_and_redaction(spark):
    text = "IBAN GB82 WEST 1234 5698 7654 32, not GB82 WEST 1234 5698 7654 33. ssn 123-45-6789; 123-45-6789. tel 212-555-0100 or a@b.org"
    df = spark.createDataFrame([(1, text), (2, None), (3, "plain")], "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.find_spans(df).collect()}
    assert [(s.kind, s.found) for s in rows[1].pii_spans] == [
        ("iban", "GB82 WEST 1234 5698 7654 32"), ("national_id", "123-45-6789"), ("national_id", "123-45-6789"),
        ("local_phone", "212-555-0100"),
        ("email", "a@b.org")]
    clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert clean[1].startswith("IBAN <IBAN>, not") and clean[1].endswith("<LOCAL_PHONE> or <EMAIL>")
    assert (clean[2], clean[3]) == (None, "plain")


def test_every_operator_takes_the_awkward_table(spark, tiny):
    labels = spark.createDataFrame([(0, 1), (0, 1), (2, 1), (3, 0), (5, 1), (None, 1), (6, None)], "doc_id long, quality int")
    assert pii.find_spans(tiny).count() == tiny.count() and pii.redact(tiny).columns == tiny.columns
    scores, _ = pu_quality.score_documents(tiny, labels)
    assert scores.count() == tiny.count() and scores.filter("score between 0 and 1").count() == tiny.count()
    assert pu_quality.score_documents(tiny.limit(0), labels)[0].isEmpty()
    alone, model = pu_quality.score_documents(tiny, labels.limit(0))
    assert {r.score for r in alone.collect()} == {0.5} and not any(model.weights)
    trusted = spark.createDataFrame([(0,), (5,)], "doc_id long")
    judged = ngram_rules.judge(tiny, trusted).collect()
    assert collections.Counter(r.doc_id for r in judged) == collections.Counter(i for i, _ in collected(tiny))
    assert ngram_rules.judge(tiny.limit(0), trusted).isEmpty()
    known = license_digest.known_digests(spark)
    assert license_digest.scan(tiny, known).count() == len(set(collected(tiny)))
    assert license_digest.scan(tiny.limit(0), known).isEmpty()
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    assert decontaminate.without_benchmark(tiny, bench).count() == tiny.count()
    for name, stage in corpus_pipeline.STAGES[1:2] + corpus_pipeline.STAGES[3:4]:
        assert stage(spark, tiny, "").columns == tiny.columns, name
        assert stage(spark, tiny.limit(0), "").isEmpty()


def test_rule_counts(tiny, spark):
    trusted = spark.createDataFrame([(0,)], "doc_id long")

    def brute(text):
        words, text = WORD.findall(text or ""), text or ""
        seen, repeated = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                repeated += line in seen
                seen.add(line)
        count = collections.Counter(tuple(words[n:n + 3]) for n in range(len(words) - 2))
        covered = {n + k for n in range(len(words) - 2) if count[tuple(words[n:n + 3])] > 1 for k in range(3)}
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed

    got = collections.Counter((r.doc_id, *(r[c] for c in ngram_rules.COUNTS), r.base_failed)
                              for r in ngram_rules.judge(tiny, trusted).collect())
    assert got == collections.Counter((i, *brute(t)) for i, t in collected(tiny))


def test_prior_and_risk():
    positive, unlabelled = np.zeros(100), np.zeros(100)
    positive[60:], unlabelled[60:], unlabelled[:40] = 1000, 700, 300
    assert abs(pu_quality.prior_of(positive, unlabelled) - 0.7) < 0.02
    assert pu_quality.prior_of(np.zeros(5), np.ones(5)) == 0.5


def test_quality_on_held_out_labels(spark, small):
    rows = queries.op3_pu_quality(spark, small.replace("0.001", "0.01")).filter("held_out")
    labels = queries.table(spark, small.replace("0.001", "0.01"), "labels")
    both = rows.join(labels, "doc_id").select(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()
    assert both[0] > 0.95


def test_url_rules(spark):
    urls = [None, "", "example.org/es/", "http://example.org", "http://example.org/", "http://A.Example.ORG/es/x?y#z",
            "x://example.org/en/12", "x://example.org/en/2", "x://notexample.org/es/", "x://a.com/fr/1", "x://a.com/de/",
            "x://a.com/DE/", "a://b://c.com/de/", "x://www.casino-win.net/en", "x://casinos.net/", "x://com/de/é\n/"]
    pages = spark.createDataFrame([(n, u) for n, u in enumerate(urls)] + [(1, ""), (None, urls[5])], "page_id long, url string")
    found = collections.Counter(map(tuple, url_rules.judge(pages.withColumn("token", F.lit(1))).collect()))
    oracle = duckdb.connect()
    oracle.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    oracle.executemany("INSERT INTO pages VALUES (?, ?)", [tuple(r) for r in pages.collect()])
    assert found == collections.Counter(oracle.execute(queries.SQL["op4_url_rules"]).fetchall())
    assert url_rules.judge(pages.limit(0)).isEmpty()


def test_warc_packages(spark, tmp_path):
    big, small_ = "é<p>" * 60, "tiny"
    pages = [(3, "http://a/", big), (1, "x\r\ny", big), (2, None, big), (2, "u", big), (4, "u", small_), (5, "u", small_),
             (6, "u", None), (7, "u", ""), (None, "u", big), (None, None, None), (1, "again", big)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    packages = warc_zip.write_packages(df, f"file://{tmp_path}/p", package_bytes=200)
    assert packages.agg(F.sum("records")).first()[0] == len(pages) and packages.count() > 3
    for row in packages.collect():
        assert zipfile.ZipFile(row.package.removeprefix("file://")).testzip() is None
    want = []
    for page_id, _, html in pages:
        data = (html or "").encode()
        revisit = html == big and page_id is not None and page_id > 1
        want.append((page_id, "revisit" if revisit else "response", 1 if revisit else None, len(data),
                     hashlib.sha256(data).hexdigest(), None if revisit else data))
    got = warc_zip.read_records(warc_zip.locate(packages)).drop("url")
    assert collections.Counter((*r[:5], r[5] and bytes(r[5]) if r[5] is not None else None) for r in got.collect()) == \
        collections.Counter(want)
    assert warc_zip.write_packages(df.limit(0), f"file://{tmp_path}/q").isEmpty()


def test_zip64_directory(tmp_path):
    """A small file whose directory uses every ZIP64 field, with a comment that looks like an end record."""
    data, name = b"hello range", b"archive/x"
    local = struct.pack("<4s5H3I2H", b"PK\3\4", 45, 0x800, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name
    local += struct.pack("<HHQQ", 1, 16, len(data), len(data)) + data
    extra = struct.pack("<HHB", 0x9999, 1, 7) + struct.pack("<HHQQQ", 1, 24, len(data), len(data), 5)
    entry = struct.pack("<4s6H3I5H2I", b"PK\1\2", 45, 45, 0x800, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name),
                        len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    begin = 5 + len(local)
    end_64 = struct.pack("<4sQ2H2I4Q", b"PK\6\6", 44, 45, 45, 0, 0, 1, 1, len(entry), begin)
    locator = struct.pack("<4sIQI", b"PK\6\7", 0, begin + len(entry), 1)
    end = struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 4) + b"PK\5\6"
    (tmp_path / "z").write_bytes(b"front" + local + entry + end_64 + locator + end)
    with pafs.LocalFileSystem().open_input_file(str(tmp_path / "z")) as file:
        found = warc_zip.members(file)["archive/x"]
        assert (found.method, file.read_at(found.size, found.begin)) == (0, data)
    with pytest.raises(ValueError, match="not a ZIP"):
        warc_zip.members(pa.BufferReader(b"x" * 100))
    plain = io.BytesIO()
    with zipfile.ZipFile(plain, "w") as out:
        out.writestr("a", b"1")
    assert warc_zip.members(pa.BufferReader(plain.getvalue()))["a"].size == 1


def test_suffix_sums(spark, monkeypatch):
    monkeypatch.setattr(token_lengths, "_BLOCK", 4)
    lengths = [0, 0, 1, 3, 3, 5, 9, 9, 9, 17]
    counts = spark.createDataFrame(collections.Counter(lengths).items(), "n_tokens long, n_docs long")
    sums = token_lengths.suffix_sums(counts).cache()
    for r in sums.collect():
        tail = [n for n in lengths if n >= r.n_tokens]
        assert (r.docs_from, r.tokens_from) == (len(tail), sum(tail))
        assert r.truncated_tokens == sum(min(n, r.n_tokens) for n in lengths)
        assert r.quantile == pytest.approx(sum(n <= r.n_tokens for n in lengths) / len(lengths))
    limits = spark.createDataFrame([(0,), (4,), (100,)], "limit long")
    got = {r.limit: (r.docs_cut, r.total_tokens) for r in token_lengths.at_limits(sums, limits).collect()}
    assert got == {m: (sum(n > m for n in lengths), sum(min(n, m) for n in lengths)) for m in (0, 4, 100)}
    assert {r.share: r.n_tokens for r in token_lengths.at_quantiles(sums, [0.5, 1.0]).collect()} == {0.5: 3, 1.0: 17}
    assert token_lengths.suffix_sums(counts.limit(0)).isEmpty()


def test_license_forms(spark):
    mit = license_digest.KNOWN[6][1]
    same = "Copyright (c) 2020 A. Person\n© B\n\n" + mit.replace("Software", "SOFTWARE").replace(" ", "  ").replace(",", " ,")
    texts = [mit, same, mit + " extra", "x\nReleased under the MIT Licence!\nLicensed under CC BY-NC 4.0.\n", None, "", "(c)"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.license, r.notices, r.n_notices) for r in license_digest.scan(df, license_digest.known_digests(spark)).collect()}
    none = (None, "", 0)
    assert got == {0: ("MIT", "MIT", 1), 1: ("MIT", "MIT", 1), 2: none,
                   3: (None, "CC-BY-NC-4.0,MIT", 2), 4: none, 5: none, 6: none}


BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
APACHE_HEADER = """Copyright 2021 A. Person

Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    https://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.
"""


def licenses_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.license for r in license_digest.scan(df, license_digest.known_digests(spark)).collect()}
    return [found[n] for n in range(len(texts))]


def test_entire_license_texts(spark):
    mit = license_digest.KNOWN[6][1]
    titled = "BSD 2-Clause License\n\nCopyright (c) 2020, B\nAll rights reserved.\n\n" + BSD_2.replace("1.", "*").replace("2. R", "* R")
    texts = [BSD_2, titled, APACHE_HEADER, "MIT License\n\nCopyright (c) 2020 A\n\n" + mit, BSD_2 + "extra", BSD_2[:-90]]
    assert licenses_of(spark, texts) == ["BSD-2-Clause", "BSD-2-Clause", "Apache-2.0", "MIT", None, None]


@pytest.mark.parametrize("file, name", [
    ("Apache-2.0", "Apache-2.0"), ("GPL-2", "GPL-2.0"), ("GPL-3", "GPL-3.0"), ("LGPL-2.1", "LGPL-2.1"), ("LGPL-3", "LGPL-3.0"),
    ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0"),
])
def test_license_files_of_the_system(spark, file, name):
    path = pathlib.Path("/usr/share/common-licenses", file)
    if not path.exists():
        pytest.skip("no such file here")
    text = path.read_text()
    assert licenses_of(spark, [text, " ".join(text.upper().splitlines(True)), text[:-200]]) == [name, name, None]


def plain_bpe(word, ranks):
    parts = list(word)
    while len(parts) > 1:
        pairs = [(ranks.get((a, b), 1 << 30), n) for n, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, at = min(pairs)
        if rank == 1 << 30:
            break
        left, right = parts[at], parts[at + 1]
        out, n = [], 0
        while n < len(parts):
            if parts[n:n + 2] == [left, right]:
                out.append(left + right)
                n += 2
            else:
                out.append(parts[n])
                n += 1
        parts = out
    return parts


@pytest.mark.parametrize("seed", range(6))
def test_gadgets_give_the_merges_result(seed):
    """Random merge lists over three letters, runs of one letter among them; every word up to seven letters."""
    draw = random.Random(seed)
    letters = list(bpe.byte_letters())
    tokens, merges = list("abc"), []
    while len(merges) < 9:
        pair = (draw.choice(tokens), draw.choice(tokens))
        if pair not in merges and "".join(pair) not in tokens:
            merges.append(pair)
            tokens.append("".join(pair))
    vocab = {t: n for n, t in enumerate([*letters, *tokens[3:]])}
    automaton = bpe.build(vocab, merges, {})
    ranks = {pair: n for n, pair in enumerate(merges)}
    words = ["".join(w) for size in range(1, 8) for w in itertools.product("abc", repeat=size)]
    want = [[vocab[p] for p in plain_bpe(w, ranks)] for w in words]
    assert [automaton.encode_word(w.encode()) for w in words] == want
    together = automaton.encode_words([w.encode() for w in words])
    assert [list(struct.unpack(f"<{len(ids) // 4}I", ids)) for ids in together] == want


def test_encoding_equals_the_tokenizers_library(spark, tiny, monkeypatch):
    from tokenizers import Tokenizer

    path = queries.tokenizer_file()
    theirs = Tokenizer.from_file(path)
    ids = lambda t: np.array(theirs.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    draw = random.Random(1)
    pieces = list("aabcde  \n\t'sthe0123٣²½…—ñÉ中字😀\u3000\xa0\x85\x1c .,!|'") + ["<|endoftext|>", " the", "'ll", "\r\n", "\0"]
    texts = ["".join(draw.choices(pieces, k=draw.randint(0, 30))) for _ in range(2000)]
    automaton = bpe.compile_file(path)
    monkeypatch.setattr(bpe, "_CACHED", 200)
    assert automaton.encode_all(texts) == [ids(t) for t in texts]
    assert [automaton.encode(t) for t in texts] == [ids(t) for t in texts]
    got = bpe.decode(bpe.encode(tiny, path), path).select("doc_id", "token_ids", "decoded").collect()
    want = [(i, ids(t or ""), t or "") for i, t in collected(tiny)]
    assert collections.Counter((r[0], bytes(r[1]), r[2]) for r in got) == collections.Counter(want)
    both = bpe.round_trip(tiny, path).select("doc_id", "token_ids", "decoded").collect()
    assert collections.Counter(map(tuple, both)) == collections.Counter(map(tuple, got))
    counted = collections.Counter(len(ids(t or "")) // 4 for _, t in collected(tiny))
    assert {r.n_tokens: r.n_docs for r in token_lengths.histogram(tiny, path).collect()} == counted
