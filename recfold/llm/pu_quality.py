"""Quality classifier learned from trusted positives and unlabelled text (PU learning).

The model is linear in fixed functions of character and word shares. With the squared loss the
non-negative unbiased risk

    prior * P[(1 - g)^2 / 4] + max(0, U[(1 + g)^2 / 4] - prior * P[(1 + g)^2 / 4])

depends on the data through first and second moments of those functions over positives (P) and
over all text (U) only. They come from one distributed pass over every document, so the risk that
the driver minimises is the exact one of the whole corpus, and what reaches the driver has the
size of the model squared. The class prior is the smallest ratio of the unlabelled share to the
positive share above a score: where only positives are left, it is the prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recfold.llm.rows import HASH, ID, NO_ID, identity, map_batches, slices, stored
from recfold.llm.text_arrays import Texts, hash_ranges, runs, spans, texts_of, whole_windows, windows

_MARKS = b"#$%&*@^~\\<>{}[]=+_/|!?\"'`;:-()"
_CLASSES = len(_MARKS) + 9
_SHARE_SCALES = (0.01, 0.1, 0.5)
_MEET = 64
_BINS = 200


def _byte_classes() -> np.ndarray:
    """A class for each byte: one per mark, then lower, upper, digit, dot, space, line end, lead, trail, other."""
    table = np.full(256, len(_MARKS) + 8)
    for number, mark in enumerate(_MARKS):
        table[mark] = number
    base = len(_MARKS)
    for number, group in enumerate((range(97, 123), range(65, 91), range(48, 58), b".,", b" \t", b"\r\n",
                                    range(192, 256), range(128, 192))):
        table[list(group)] = base + number
    return table


_CLASS = _byte_classes()
_BLANK = np.isin(np.arange(256), list(b" \t\r\n\x0b\x0c"))


def features(texts: Texts) -> np.ndarray:
    """One row of basis functions per text: hinges of shares, of word lengths and of repetition."""
    count = len(texts)
    size = np.diff(texts.bounds)
    owner = np.repeat(np.arange(count), size)
    shares = np.bincount(owner * _CLASSES + _CLASS[texts.data], minlength=count * _CLASSES)
    shares = shares.reshape(count, _CLASSES) / np.maximum(size, 1)[:, None]
    words = runs(texts, ~_BLANK[texts.data])
    n_words = np.diff(words.first)
    some = np.maximum(n_words, 1)
    lengths = words.ends - words.starts

    def share(flag: np.ndarray) -> np.ndarray:
        return np.bincount(words.text[flag], minlength=count) / some

    per_word = [share(lengths <= limit) for limit in (1, 2, 3, 5, 8, 12)]
    places = whole_windows(words, 3)
    hashes = windows(hash_ranges(texts.data, words.starts, words.ends), (0, 1, 2))[places]
    owner = words.text[places]
    order = np.lexsort((hashes, owner))
    same = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    repeated = np.bincount(owner[order][1:][same], minlength=count) / some
    mean = np.bincount(words.text, weights=lengths, minlength=count) / some
    raw = np.column_stack([shares, *per_word, repeated])
    columns = [np.ones((count, 1))]
    columns += [np.minimum(raw / scale, 1) for scale in _SHARE_SCALES]
    columns.append(np.column_stack(
        [np.clip((mean - knot) / 3, 0, 1) for knot in (2, 5, 8, 11)]
        + [np.clip((np.log2(some) - knot) / 3, 0, 1) for knot in (0, 3, 6, 9)]
    ))
    return np.column_stack(columns)


@dataclass
class Model:
    weights: list[float]
    prior: float

    def raw(self, basis: np.ndarray) -> np.ndarray:
        return basis @ np.array(self.weights)


@dataclass
class Moments:
    count: float
    mean: np.ndarray
    square: np.ndarray

    @staticmethod
    def of(values: list[float] | None) -> Moments:
        width = len(features(texts_of(pa.array([""])))[0])
        flat = np.array(values if values else np.zeros(1 + width + width * width))
        total = max(flat[0], 1)
        return Moments(flat[0], flat[1: width + 1] / total, flat[width + 1:].reshape(width, width) / total)


def minimise(positive: Moments, unlabelled: Moments, prior: float, ridge: float = 1e-4) -> np.ndarray:
    """Weights of least non-negative risk, with ``ridge`` times their square added.

    The risk is the greater of two convex functions: the positives' part, and that part plus the
    estimated risk of the negatives, which is the unbiased risk. Its minimum is that of a mean of
    the two, ``t`` parts of the second, for the ``t`` where the negatives' part is zero; at either
    end of 0 to 1 that part may keep its sign. It falls as ``t`` grows, so halving finds ``t``.
    """
    eye = 2 * ridge * np.eye(len(positive.mean))

    def solve(t: float) -> np.ndarray:
        square = (1 - t) * prior * positive.square + t * unlabelled.square
        return np.linalg.solve(square / 2 + eye, ((1 + t) * prior * positive.mean - t * unlabelled.mean) / 2)

    def negative_part(w: np.ndarray) -> float:
        def risk(m: Moments) -> float:
            return (1 + 2 * m.mean @ w + w @ m.square @ w) / 4

        return risk(unlabelled) - prior * risk(positive)

    if negative_part(weights := solve(1.0)) >= 0:
        return weights
    if negative_part(weights := solve(0.0)) <= 0:
        return weights
    low, high = 0.0, 1.0  # above zero at low, below at high
    for _ in range(80):
        middle = (low + high) / 2
        if negative_part(weights := solve(middle)) > 0:
            low = middle
        else:
            high = middle
    return weights


def prior_of(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Class prior from two histograms of one score, lowest bin first."""
    above_p = positive[::-1].cumsum() / max(positive.sum(), 1)
    above_u = unlabelled[::-1].cumsum() / max(unlabelled.sum(), 1)
    enough = above_p >= 0.2
    if not positive.sum() or not enough.any():
        return 0.5
    slack = np.sqrt(np.log(200) / 2) * (1 / np.sqrt(positive.sum()) + 1 / np.sqrt(max(unlabelled.sum(), 1)))
    ratio = (above_u + slack)[enough] / above_p[enough]
    best = int(np.argmin(ratio))
    return float(np.clip(above_u[enough][best] / above_p[enough][best], 0.01, 0.99))


def _basis(docs: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows = features(texts_of(part.column("text"))).astype(np.float32)
            flat = pa.array(rows.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), flat)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], names=[ID, HASH, "basis"])

    rows = docs.select(*identity(), F.col("text").cast("string").alias("text"))
    return map_batches(rows, work, f"{ID} long, {HASH} long, basis array<float>")


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(np.float64)


def _moments(rows: DataFrame) -> dict[bool, Moments]:
    """Sums over all rows (False) and over trusted ones (True): per task, then in rounds of groups, however many tasks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[bool, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            basis = _matrix(batch.column("basis"))
            trusted = batch.column("trusted").to_numpy(zero_copy_only=False)
            for kind, some in ((False, basis), (True, basis[trusted])):
                part = np.concatenate([[len(some)], some.sum(0), (some.T @ some).ravel()])
                sums[kind] = sums.get(kind, 0) + part
        for kind, part in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([part.tolist()])], names=["kind", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[bool, np.ndarray] = {}
        for batch in batches:
            for kind, part in zip(batch.column("kind").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                sums[kind] = sums.get(kind, 0) + np.array(part)
        for kind, part in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([part.tolist()])], names=["kind", "sums"])

    schema = "kind boolean, sums array<double>"
    parts = stored(map_batches(rows.select("basis", "trusted"), work, schema), "moments")
    number = parts.count()
    while number > 2 * _MEET:  # each round leaves two sums of up to so many
        groups = -(-number // _MEET)
        parts, number = stored(map_batches(parts.repartition(groups), add, schema), "moments"), 2 * groups
    totals: dict[bool, np.ndarray] = {}
    for kind, sums in parts.toLocalIterator():
        totals[kind] = totals.get(kind, 0) + np.array(sums)
    return {kind: Moments.of(totals.get(kind, np.zeros(0)).tolist()) for kind in (False, True)}


def _scores(basis: np.ndarray, weights: list[float]) -> np.ndarray:
    """Scores of rows of basis functions, which count as the single floats they are stored in."""
    return np.clip((1 + basis.astype(np.float32).astype(np.float64) @ np.array(weights)) / 2, 0, 1)


def _scored(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    values = [float(w) for w in weights]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            basis = _matrix(batch.column("basis")) if batch.num_rows else np.zeros((0, len(values)))
            score = pa.array(_scores(basis, values))
            columns = [batch.column(ID), batch.column(HASH), batch.column("trusted"), score]
            yield pa.RecordBatch.from_arrays(columns, names=[ID, HASH, "trusted", "score"])

    return map_batches(rows, work, f"{ID} long, {HASH} long, trusted boolean, score double")


def remainder(doc_id):
    """crc32 of the id as text, modulo 3; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids whose labels may be learned from and all say quality 1; once each."""
    known = labels.select(F.col("doc_id").cast("long").alias(ID), F.col("quality").alias("quality"))
    known = known.filter(F.col(ID).isNotNull() & F.col("quality").isNotNull() & (remainder(F.col(ID)) != 1))
    return known.groupBy(ID).agg(F.min("quality").alias("quality")).filter("quality = 1").select(ID)


def _fitted(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Model]:
    """The basis of every row, and the model."""
    trusted = trusted_ids(labels).withColumn("trusted", F.lit(True))
    rows = stored(_basis(docs), "basis").join(trusted, ID, "left")
    rows = stored(rows.withColumn("trusted", F.coalesce("trusted", F.lit(False))), "labelled")
    moments = _moments(rows)
    positive, unlabelled = moments[True], moments[False]
    if not positive.count:
        return rows, Model([0.0] * len(positive.mean), 0.5)
    first = _scored(rows, minimise(positive, unlabelled, 0.5))
    counts = first.groupBy(F.floor(F.col("score") * _BINS).cast("int").alias("bin")).agg(
        F.sum(F.col("trusted").cast("int")).alias("p"), F.count("*").alias("u")
    )
    histogram = np.zeros((2, _BINS + 1))
    for row in counts.collect():  # at most _BINS + 1 rows
        histogram[:, row["bin"]] = row["p"], row["u"]
    prior = prior_of(*histogram)
    return rows, Model(minimise(positive, unlabelled, prior).tolist(), prior)


def score_documents(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Model]:
    """``(identity, trusted, score)`` for every row of ``docs`` (``doc_id``, ``text``), and the model.

    Trusted positives are documents whose usable labels all say quality 1; every document counts
    as unlabelled text. Scores lie in 0 to 1, the estimated probability of quality 1. NULL is the
    empty text. Repeated rows count as often as they are there and score alike; rows without an id
    are unlabelled text. Without any trusted positive the model is zero and all scores are 0.5; an
    empty table gives no rows. Other columns are not looked at.
    """
    rows, model = _fitted(docs, labels)
    return _scored(rows, np.array(model.weights)), model


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that `score_documents` gives ``least`` or more, with all their columns.

    The score is a function of the text, so rows are scored and sorted out where they are read.
    """
    _, model = _fitted(docs, labels)
    weights = model.weights

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            yield part.filter(pa.array(_scores(features(texts_of(part.column("text"))), weights) >= least))

    rows = docs.withColumn("text", F.col("text").cast("string"))
    return map_batches(rows, work, rows.schema)


def id_column():
    return F.when(F.col(ID) != NO_ID, F.col(ID))
