"""Results that have to be exact: counts of equal lines and words, least risk, short benchmark items, the pipeline."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from recfold.llm import decontaminate, ngram_rules, pii, pu_quality, queries, rows, simhash, text_arrays
from recfold.llm.rows import HASH, ID


def thue_morse(size):
    """The word over a and b, and its complement: equal under any polynomial hash modulo a power of two."""
    bits = [bin(n).count("1") % 2 for n in range(size)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("size", [1024, 2048, 4096])
def test_different_lines_and_words_are_never_equal(spark, size):
    one, other = thue_morse(size)
    texts = [f"{one}\n{other}", " ".join([one, "x", "y", other, "x", "y"]), f"{one}\n{one}\n{other}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in ngram_rules.judge(df, df.select("doc_id").limit(0)).collect()}
    assert [got[n].n_dup_lines for n in range(3)] == [0, 0, 1]
    assert [got[n].n_repeat_words for n in range(3)] == [0, 0, 0]


def test_long_words_that_a_polynomial_takes_for_equal_have_hashes_of_their_own():
    for size in (63, 64, 65, 128, 1024, 4096):
        words = [w.encode() for w in (*thue_morse(size), "a" * size, "a" * (size + 1), "a" * (size + 64))]
        data = np.frombuffer(b" ".join(words), np.uint8)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = ends - [len(w) for w in words]
        hashes = text_arrays.hash_ranges(data, starts, ends)
        assert len(set(hashes.tolist())) == len(words)
        again = text_arrays.hash_ranges(np.frombuffer(b"xy " + b" ".join(words), np.uint8), starts + 3, ends + 3)
        assert (again == hashes).all()
        assert len(set(text_arrays.codes(data, starts, ends).tolist())) == len(words)


def drawn_moments(draw, width):
    def of(shift):
        basis = draw.normal(shift, 1, (40, width))
        basis[:, 0] = 1
        return pu_quality.Moments(40, basis.mean(0), basis.T @ basis / 40)

    return of(draw.normal(0, 1, width)), of(draw.normal(0, 0.3, width))


def risk_of(w, positive, unlabelled, prior, ridge):
    def part(m, sign):
        return (1 + 2 * sign * m.mean @ w + w @ m.square @ w) / 4

    negatives = part(unlabelled, 1) - prior * part(positive, 1)
    return prior * part(positive, -1) + max(0, negatives) + ridge * w @ w, negatives


def test_risk_is_least_against_a_grid():
    """Two weights, a grid drawn closer around its best point: 100 cases, most with the negatives' part cut off."""
    draw = np.random.default_rng(3)
    cut = 0
    for _ in range(100):
        positive, unlabelled = drawn_moments(draw, 2)
        prior, ridge = draw.uniform(0.3, 0.99), 1e-3
        found, negatives = risk_of(pu_quality.minimise(positive, unlabelled, prior, ridge), positive, unlabelled, prior, ridge)
        cut += negatives < 1e-9
        middle, width = np.zeros(2), 8.0
        for _ in range(40):
            steps = np.linspace(-width, width, 21)
            points = [middle + np.array([x, y]) for x in steps for y in steps]
            risks = [risk_of(p, positive, unlabelled, prior, ridge)[0] for p in points]
            middle, width = points[int(np.argmin(risks))], width * 0.6
        assert found <= min(risks) + 1e-6
    assert cut > 30


def test_risk_cannot_be_lowered_in_any_direction():
    draw = np.random.default_rng(8)
    for _ in range(100):
        positive, unlabelled = drawn_moments(draw, 12)
        prior = draw.uniform(0.5, 0.99)
        w = pu_quality.minimise(positive, unlabelled, prior)
        found = risk_of(w, positive, unlabelled, prior, 1e-4)[0]
        for size in (1, 1e-1, 1e-2, 1e-3):
            for step in draw.normal(0, size, (50, 12)):
                assert risk_of(w + step, positive, unlabelled, prior, 1e-4)[0] >= found - 1e-9


def plain_tokens(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def brute_overlaps(docs, items):
    """Every window of every document against every item, aligned; all columns."""
    groups = collections.defaultdict(list)
    for item_id, text in items:
        if tuple(plain_tokens(text)):
            groups[tuple(plain_tokens(text))].append(item_id)
    found = set()
    for doc_id, text in set(docs):
        words = plain_tokens(text)
        for item, ids in groups.items():
            size = min(decontaminate.WINDOW, len(item))
            need = decontaminate.SHARE * size if size >= decontaminate.LEAST else size
            best = None
            for at in range(len(words) - size + 1):
                for start in range(len(item) - size + 1):
                    same = sum(a == b for a, b in zip(words[at: at + size], item[start: start + size]))
                    if same >= need and (best is None or same > best[0]):
                        best = (same, at, size)
            if best:
                found.add((doc_id, min(ids), len(ids), best[1], best[2], best[0]))
    return found


def test_items_of_any_length_against_all_windows(spark):
    draw = random.Random(9)
    word = lambda: draw.choice("abcdefghijklmnopqrstuvwxyz") + draw.choice("xyz")
    items = [(n, " ".join(word() for _ in range(n))) for n in range(1, 26)]
    items += [(40, items[2][1].upper()), (41, "!"), (42, None), (43, "a"), (44, " ".join(["xx"] * 9))]
    docs = [(n, " ".join(word() for _ in range(draw.randint(0, 60)))) for n in range(30)]
    for n, (_, text) in enumerate(items):
        copy = (text or "").split()
        for _ in range(len(copy) // 5):
            copy[draw.randrange(len(copy))] = "qq"
        docs.append((100 + n, " ".join(["b9", text or "", "c9"])))
        docs.append((200 + n, " ".join(["b9", *copy, "c9"])))
    docs += [(300, None), (301, ""), (302, "xx " * 4000), docs[3], docs[3]]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("size", F.lit(1))
    columns = ("item_id", "n_items", "token_at", "n_tokens", "n_same")
    got = [(r[ID], *(r[c] for c in columns)) for r in decontaminate.overlaps(df, bench).collect()]
    want = brute_overlaps(docs, items)
    assert len(got) == len(set(got)) and set(got) == want
    assert {item for _, item, *_ in want} >= set(range(1, 26))


@pytest.mark.parametrize("number", [0, 1, 50, 5000])
def test_only_rows_named_are_left_out(spark, number):
    """Whatever the size of the bitmap: removed ones go, repeated ones stay once, all others stay as often as they are."""
    docs = [(n if n % 7 else None, f"t{n % 900}") for n in range(3000)] + [(5, "t5"), (5, "t5"), (9, None), (9, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("hash", F.lit("clash"))
    every = rows.with_identity(df).select("doc_id", "text", ID, HASH).distinct().collect()
    gone = random.Random(number).sample(every, min(number, len(every)))
    twice = [r for r in every if docs.count((r.doc_id, r.text)) > 1]
    key = f"{ID} long, {HASH} long"
    frame = lambda some: spark.createDataFrame([(r[ID], r[HASH]) for r in some], key)
    got = collections.Counter((r.doc_id, r.text) for r in rows.without(df, frame(gone), frame(twice)).collect())
    left = collections.Counter(docs)
    for r in twice:
        left[r.doc_id, r.text] = 1
    for r in gone:
        del left[r.doc_id, r.text]
    assert got == left


def fingerprint_of(text):
    import xxhash

    plain = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", plain)
    shingles = [" ".join(words[n: n + 3]) for n in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Documents of sf0.001 with NULLs, empty texts, repeated rows, copies, benchmark passages and personal data."""
    folder = tmp_path_factory.mktemp("planted")
    small = "/root/testdata/sf0.001"
    docs = queries.table(spark, small, "documents")
    given = docs.orderBy("doc_id").limit(120).collect()
    good = [r for r in given if r.text and len(r.text) > 300]
    items = [r.text for r in queries.table(spark, small, "benchmark").orderBy("item_id").limit(3).collect()]
    more = [
        (900, None, "en", "s", None), (901, "", "en", "s", 0), (None, good[0].text, "en", "s", 1), (903, good[1].text, "x", "s", 1),
        (904, good[2].text + " " + items[0], "en", "s", 1), (905, items[1], "en", "s", 1),
        (906, good[3].text + " Write to some.one@example.org or 10.1.2.3 now.", "en", "s", 1), (907, "###", "en", "s", 3),
        tuple(given[5]), tuple(given[5]), (908, "yes " * 3000, "en", "s", 1),
    ]
    docs = spark.createDataFrame([tuple(r) for r in given] + more, docs.schema)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        queries.table(spark, small, name).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_whole_pipeline_against_plain_stages(spark, planted):
    """Every stage in plain Python but the classifier's weights and the spans of personal data beyond the base kinds."""
    docs = [tuple(r) for r in queries.table(spark, planted, "documents").collect()]
    scores, _ = pu_quality.score_documents(queries.table(spark, planted, "documents"), queries.table(spark, planted, "labels"))
    known = {r.text: r.score for r in queries.table(spark, planted, "documents").join(
        scores.select(F.col(HASH), "score").distinct(),
        F.xxhash64("text", F.col("text").isNull(), F.col("doc_id").isNull()) == F.col(HASH)).select("text", "score").collect()}
    kept = [d for d in docs if known[d[1]] >= 0.5]
    assert 20 < len(kept) < len(docs)

    marks = {d[1]: fingerprint_of(d[1]) for d in kept}
    distinct = sorted(set(marks.values()))
    root = {m: m for m in distinct}

    def find(m):
        while root[m] != m:
            m = root[m]
        return m

    for a in distinct:
        for b in distinct:
            if bin(a ^ b).count("1") <= 3:
                root[find(a)] = find(b)
    groups = collections.defaultdict(set)
    for d in kept:
        groups[find(marks[d[1]])].add(d)
    kept = []
    for some in groups.values():
        least = min((d[0] is None, d[0] or 0) for d in some)
        first = {d for d in some if (d[0] is None, d[0] or 0) == least}
        kept.append((first, len(first)))
    # Two rows of one id in a group: which text stands for it is told by a hash, so either may.
    single = [next(iter(first)) for first, n in kept if n == 1]
    assert len(single) == len(kept)
    items = [tuple(r) for r in queries.table(spark, planted, "benchmark").select("item_id", "text").collect()]
    hit = {doc for doc, *_ in brute_overlaps([(n, d[1]) for n, d in enumerate(single)], items)}
    kept = [d for n, d in enumerate(single) if n not in hit]
    assert hit and {904, 905} & {single[n][0] for n in hit}

    clean = spark.createDataFrame(kept, queries.table(spark, planted, "documents").schema)
    clean = {tuple(r)[:1] + tuple(r)[2:4]: r.text for r in pii.redact(clean).collect()}
    assert "some.one@example.org" not in "".join(t or "" for t in clean.values())
    encoder = tokenizers.Tokenizer.from_file(queries.tokenizer_file())
    encoder.no_truncation()
    encoder.no_padding()
    want = set()
    for key, text in clean.items():
        ids = encoder.encode(text or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        want.add((*key, hashlib.sha256((text or "").encode()).hexdigest(), hashlib.sha256(raw).hexdigest(), len(ids)))
    got = corpus_pipeline.run(spark, planted).collect()
    assert all(r.round_trip for r in got)
    assert {(r.doc_id, r.lang, r.source, hashlib.sha256((r.text or "").encode()).hexdigest(),
             hashlib.sha256(bytes(r.token_ids)).hexdigest(), r.n_tokens) for r in got} == want
    assert len(got) == len(want)


def test_pipeline_of_no_documents(spark, planted, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        queries.table(spark, planted, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns[:5] == queries.table(spark, planted, "documents").columns


def test_each_stage_takes_the_awkward_rows(spark, planted):
    docs = queries.table(spark, planted, "documents").withColumn("score", F.lit("clash")).withColumn("fp", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, planted)
        assert kept.columns == docs.columns, name
        assert kept.count() <= docs.count()


def test_near_duplicates_keep_one_of_each(spark, planted):
    docs = queries.table(spark, planted, "documents")
    groups = simhash.simhash_components(docs).collect()
    kept = simhash.one_of_each(docs).collect()
    assert len(kept) == len({(r.first_id, r.first_hash) for r in groups})


def test_paths_of_words_are_traced_together(monkeypatch):
    """The same ids as word by word, for empty words and lists too, without a pack for each word."""
    from recfold.llm import bpe

    letters = {v: k for k, v in bpe.byte_letters().items()}
    vocab = {letters[n]: n for n in range(256)} | {"ab": 256, "abc": 257, "bc": 258}
    automaton = bpe.build(vocab, [("a", "b"), ("ab", "c"), ("b", "c")], {})
    words = [b"", b"a", b"abc", b"abcbcab", b"bcabbc", b"xab", "é".encode()]
    wanted = [np.array(automaton.encode_word(word), "<u4").tobytes() for word in words]
    monkeypatch.setattr(bpe, "struct", None)
    assert automaton.encode_words(words) == wanted and automaton.encode_words([]) == []
