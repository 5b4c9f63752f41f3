"""Spelling variants against a comparison of all pairs of words."""

import random
import re
import zlib
from collections import Counter

from recfold.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SCHEMA = "doc_id long, text string"


def counted(docs):
    found = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {word: n for word, n in found.items() if len(word) >= 5 and n >= 3}


def near(a, b):
    """Exactly one edit, told by the common start and end."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    start = next((n for n in range(len(short)) if short[n] != long[n]), len(short))
    return short[start + (len(a) == len(b)):] == long[start + 1:]


def brute(vocabulary):
    """All pairs, those of words that share a deletion: one edit apart means a common word of one letter less, or less."""
    by_part = {}
    for word in vocabulary:
        for part in {word, *(word[:n] + word[n + 1:] for n in range(len(word)))}:
            by_part.setdefault(part, set()).add(word)
    others = {word: set() for word in vocabulary}
    for some in by_part.values():
        for a in some:
            others[a] |= {b for b in some if b not in others[a] and near(a, b)}
    form = {}
    for word, found in others.items():
        best = min(found, key=lambda w: (-vocabulary[w], w), default=None)
        form[word] = best if best is not None and vocabulary[best] >= 2 * vocabulary[word] else None
    rows = set()
    for word, n in vocabulary.items():
        root = word
        while form[root] is not None:
            root = form[root]
        rows.add((word, form[word], root, n, len(others[word]), vocabulary.get(form[word])))
    return rows


def result(df):
    found = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(set(found)) == len(found)
    return set(found)


def test_given_documents(spark):
    """Every word of the documents of sf0.01."""
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in queries.table(spark, folder, "documents").collect()]
    want = brute(counted(docs))
    assert sum(form is not None for _, form, *_ in want) > 20
    assert result(queries.QUERIES["op12_pivotal_grams"](spark, folder)) == want


def test_few_letters(spark):
    """Words of two or three letters: every bigram repeats, prefixes have many ties, chains of forms are long."""
    draw = random.Random(11)
    vocabulary = {}
    for _ in range(1500):
        word = "".join(draw.choices("abé", weights=(6, 3, 1), k=draw.randint(5, 9)))
        vocabulary[word] = draw.choice((3, 4, 6, 12, 25, 50, 100, 300, 1000))
    vocabulary |= {"q" * n: 3 * 2 ** (n - 5) for n in range(5, 18)}  # one chain of twelve steps
    vocabulary |= {"ab" * 400: 3, "ab" * 400 + "a": 7, "z" * 3000: 5, "z" * 3001: 10}
    df = spark.createDataFrame(list(vocabulary.items()), "word string, n long").selectExpr("*", "1 AS id", "'x' AS form")
    want = brute(vocabulary)
    assert ("qqqqq", "qqqqqq", "q" * 17, 3) in {row[:4] for row in want}
    assert result(spelling.group(df.repartition(6))) == want


def test_awkward_documents(spark):
    """NULL ids and texts, repeated rows, no words, marks and capitals beyond ASCII, long runs of letters."""
    draw = random.Random(2)
    stock = ["".join(draw.choices("abcdeÉé×", k=draw.randint(3, 8))) for _ in range(60)]
    docs = [(n, " ".join(draw.choices(stock, k=60))) for n in range(40)]
    docs += [(None, docs[0][1]), (None, None), (3, None), (4, ""), (5, " \n!1 "), (6, "x" * 40_000), (7, "x" * 40_000)]
    docs += [(8, "ABCDE abcde Abcde abcdé ABCDÉ"), (8, "x" * 40_000), *docs[:5]]
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "'clash' AS word", "0 AS n", "'clash' AS run", "1 AS id")
    want = counted(docs)
    assert {r.word: r.n for r in spelling.words(df).collect()} == want
    assert result(spelling.group(spelling.words(df))) == brute(want)
    assert spelling.group(spelling.words(df.limit(0))).count() == 0


def test_pivots_do_not_overlap_and_are_the_rarest():
    draw = random.Random(4)
    for _ in range(500):
        word = "".join(draw.choices("abcd", k=draw.randint(5, 12)))
        ranks = {gram: n for n, gram in enumerate(draw.sample([a + b for a in "abcd" for b in "abcd"], 16))}
        prefix = spelling.prefix_of(word, ranks)
        chosen = spelling.pivots_of(prefix)
        best = min(a[0] + b[0] for a in prefix for b in prefix if b[1] >= a[1] + 2)
        assert len(chosen) == 2 and abs(chosen[0][1] - chosen[1][1]) >= 2
        assert sum(rank for rank, _ in chosen) == best
