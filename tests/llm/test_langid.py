"""Language identification: kernels against sets of n-grams, scores against the kernel, held-out accuracy."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recfold.llm import langid, queries
from recfold.llm.text_arrays import texts_of


def signs(text):
    plain = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return "".join(c if ord(c) > 127 or "a" <= c <= "z" else " " for c in plain).encode()


def buckets(text):
    """The presence row of a text, n-gram by n-gram."""
    data = signs(text)
    found = set()
    for order in range(langid.ORDERS):
        for at in range(len(data) - order):
            code = int.from_bytes(data[at: at + order + 1], "big") ^ (order * 0x2545F491 & 0xFFFFFFFF)
            found.add((code * 0x9E3779B1 & 0xFFFFFFFF) >> 32 - langid.BITS)
    return found


def drawn(number=70, seed=1):
    draw = random.Random(seed)
    stock = ["the", "Ération", "und", "ción", "の", "ab-c", "X", "12", "***", "\n", "straße"]
    texts = [" ".join(draw.choices(stock, k=draw.randint(0, 60))) for _ in range(number)]
    return [*texts, "", "a", "é", "ab", "q" * 10, None]


@pytest.mark.parametrize("step", [1 << 20, 7])
def test_presence_is_that_of_the_sets(monkeypatch, step):
    """Also for texts that are read in many steps."""
    monkeypatch.setattr(langid, "_STEP", step)
    texts = drawn()
    rows = np.concatenate(list(langid.blocks(texts_of(pa.array(texts)))))
    assert [set(np.flatnonzero(row)) for row in rows] == [buckets(text or "") for text in texts]


def test_scores_are_those_of_the_kernel():
    """The product with the folded matrix equals the ridge regression over K(x, L), solved plainly."""
    texts, labels = drawn(60), ["a", "b", "c"] * 22
    rows = np.concatenate(list(langid.blocks(texts_of(pa.array(texts)))))
    labels = labels[: len(rows)]
    marks = np.arange(0, 60, 3)
    model = langid.fit(np.packbits(rows, axis=1), labels, marks)
    sets = [buckets(text or "") for text in texts]

    def k(a, b):
        return len(a & b) / np.sqrt(max(len(a), 1) * max(len(b), 1))

    inner = np.array([[k(sets[a], sets[b]) for b in marks] for a in marks])
    cross = np.array([[k(a, sets[b]) for b in marks] for a in sets])
    values, vectors = np.linalg.eigh(inner)
    kept = values > 1e-8 * values.max()
    features = cross @ (vectors[:, kept] / np.sqrt(values[kept]))
    weight = np.array([1 / labels.count(label) / 3 for label in labels])
    for number, language in enumerate(model.languages):
        target = np.where(np.array(labels) == language, 1.0, -1.0)
        square = (features * weight[:, None]).T @ features + langid.RIDGE * np.eye(kept.sum())
        want = features @ np.linalg.solve(square, features.T @ (weight * target))
        assert np.allclose(model.scores(rows)[:, number], want, atol=1e-3)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in queries.table(spark, folder, "documents").collect()}
    got = queries.QUERIES["op13_string_kernels"](spark, folder).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    plain = [r for r in got if any(c.isalpha() for c in docs[r.doc_id].text or "")]
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r not in plain)
    out = [r for r in plain if r.held_out and docs[r.doc_id].lang is not None]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in out)
    assert len(out) > 200 and right >= 0.98 * len(out)


def test_only_text_and_labels_that_may_be_learned_from_matter(spark):
    """Predictions stay when held-out labels, ids, sources, row order and partitions change."""
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents").cache()
    held = langid.remainder(F.col("doc_id")) == 1
    other = docs.withColumns({"lang": F.when(held, "xx").otherwise(F.col("lang")), "source": F.lit("s")})
    first = {r.doc_id: r[2:] for r in langid.identify(docs).collect()}
    second = {r.doc_id: r[2:] for r in langid.identify(other.repartition(7)).collect()}
    assert first == second


def test_awkward_documents(spark):
    """NULL ids, texts and labels, no letters, one label only, very long texts, copies, clashing columns."""
    docs = [(1, "the house", "en"), (2, None, "en"), (3, "", "en"), (4, " 12 !", "de"), (None, "das Haus", "de"),
            (5, "das Haus und das", "de"), (6, "x" * 3_000_000, None), (6, "das Haus", "de"), (6, "das Haus", "de"),
            (8, "the the", None), (9, "の", "ja"), (10, "Ünd", "de"), (11, "a house", "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    df = df.selectExpr("*", "'clash' AS score", "'clash' AS h", "'clash' AS bits", "'clash' AS lettered", "1 AS held_out")
    got = langid.identify(df.repartition(3)).collect()
    assert len(got) == len(docs)
    for r in got:
        texts = [text for number, text, _ in docs if number == r.doc_id]
        if not any(c.isalpha() for c in "".join(t or "" for t in texts)):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert {r.lang_pred for r in got if r.doc_id == 6} <= {"de", "en", "ja"}
    none = df.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in langid.identify(none).collect()} == {("und", 0.0)}
    assert langid.identify(df.limit(0)).count() == 0


def test_the_sample_is_bounded_whatever_the_copies(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, concat('w', id), 'the same') AS text",
                                      "if(id % 2 = 0, 'en', 'de') AS lang")
    found = langid.sample(df, 100).collect()
    assert len(found) == 100 and len({(r.lang, r.text) for r in found}) == 100
