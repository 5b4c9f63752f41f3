"""Language identification by string kernels.

The kernel of two texts is the number of byte n-grams of one to four bytes that are present in
both (the blended spectrum, each order counted once), divided by the root of the product of their
own numbers. N-grams are hashed to buckets. Letters A to Z are lower-cased and all other ASCII
signs are taken for one blank, so that markup, digits and marks say nothing.

A ridge regression in the kernel's space tells each language from the rest. It is solved over the
space that landmark texts span (Nyström): with ``L`` the landmarks and ``X`` the sample,

    features = K(X, L) K(L, L)^(-1/2),   score(x) = K(x, L) K(L, L)^(-1/2) w.

Presence is a row of zeros and ones over buckets, so ``K(x, L)`` is a matrix product with the rows
of the landmarks. Products can be bracketed anyhow: the landmarks' rows are multiplied with the
coefficients once, and a batch of texts is scored by one product of its rows with that matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from recfold.llm.rows import map_batches, slices, stored
from recfold.llm.text_arrays import Texts, texts_of

ORDERS = 4
BITS = 15
SAMPLE = 8192  # labelled texts that the model is fitted on, shared out evenly among the languages
LANDMARKS = 512  # of them
RIDGE = 1e-3
UNKNOWN = "und"
_BUCKETS = 1 << BITS
_STEP = 1 << 20
_ROWS = 64
_FIT_ROWS = 256
_ODD = np.uint32(0x9E3779B1)
_BLANK = 0x20


def _signs() -> np.ndarray:
    """What each byte counts as."""
    table = np.arange(256, dtype=np.uint32)
    table[:128] = _BLANK
    for letter in range(26):
        table[ord("A") + letter] = table[ord("a") + letter] = ord("a") + letter
    return table


_SIGNS = _signs()


def presence(texts: Texts, low: int, high: int) -> np.ndarray:
    """A row for each of the texts ``low`` to ``high - 1``: which buckets its n-grams fall into.

    A text is read in steps, so its length is bounded by nothing here.
    """
    rows = np.zeros((high - low, _BUCKETS), bool)
    flat = rows.reshape(-1)
    start, end = int(texts.bounds[low]), int(texts.bounds[high])
    for left in range(start, end, _STEP):
        right = min(left + _STEP, end)
        signs = np.zeros(right - left + ORDERS, np.uint32)
        ahead = _SIGNS[texts.data[left: right + ORDERS]]
        signs[: len(ahead)] = ahead[: len(signs)]
        edges = np.clip(texts.bounds[low: high + 1], left, right)
        sizes = np.diff(edges)
        row = np.repeat(np.arange(high - low), sizes)
        rest = np.repeat(texts.bounds[low + 1: high + 1], sizes) - np.arange(left, right)
        code = np.zeros(right - left, np.uint32)
        for order in range(ORDERS):
            code = (code << np.uint32(8)) | signs[order: order + right - left]
            bucket = ((code ^ np.uint32(order * 0x2545F491 & 0xFFFFFFFF)) * _ODD) >> np.uint32(32 - BITS)
            place = row * _BUCKETS + bucket
            flat[place if order == 0 else place[rest > order]] = True
    return rows


def blocks(texts: Texts) -> Iterator[np.ndarray]:
    """`presence` of all texts, a bounded number of rows at a time."""
    for low in range(0, len(texts), _ROWS):
        yield presence(texts, low, min(low + _ROWS, len(texts)))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # a row for each bucket, a column for each language

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """The regressions' values, about 1 for a language and -1 for the rest."""
        own = np.sqrt(np.maximum(rows.sum(axis=1), 1))
        return (rows.astype(np.float32) @ self.weights) / own[:, None]


def _unpacked(packed: np.ndarray) -> Iterator[np.ndarray]:
    """Presence rows from rows of bits, some at a time, so that few stand in memory as numbers."""
    for low in range(0, len(packed), _FIT_ROWS):
        yield np.unpackbits(packed[low: low + _FIT_ROWS], axis=1).astype(np.float32)


def kernel(packed: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Shared n-grams of any two texts over the root of the product of their own numbers.

    ``packed`` has rows of bits, ``others`` presence rows that are scaled by the root already.
    """
    parts = [(rows @ others.T) / np.sqrt(np.maximum(rows.sum(axis=1), 1))[:, None] for rows in _unpacked(packed)]
    return np.concatenate(parts).astype(np.float64)


def fit(packed: np.ndarray, labels: list[str], landmarks: np.ndarray, ridge: float = RIDGE) -> Model:
    """One regression for each label against the rest, over the landmarks' span.

    ``packed`` has a row of bits for each text, ``landmarks`` are row numbers.
    """
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((_BUCKETS, 0), np.float32))
    marks = np.concatenate(list(_unpacked(packed[landmarks])))
    marks /= np.sqrt(np.maximum(marks.sum(axis=1), 1))[:, None]
    values, vectors = np.linalg.eigh(kernel(packed[landmarks], marks))
    kept = values > 1e-8 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])  # K(L, L)^(-1/2), without the directions that are none
    features = kernel(packed, marks) @ root
    targets = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    shares = np.bincount(np.searchsorted(languages, labels), minlength=len(languages))
    weight = (1 / shares)[np.searchsorted(languages, labels)] / len(languages)  # languages count alike
    square = features.T @ (features * weight[:, None]) + ridge * np.eye(features.shape[1])
    inner = np.linalg.solve(square, features.T @ (targets * weight[:, None]))
    return Model(languages, marks.T @ (root @ inner).astype(np.float32))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def sample(docs: DataFrame, most: int = SAMPLE) -> DataFrame:
    """``(lang, h, text)``: for each language the same number of distinct texts to learn from, ``most`` in all at most.

    They are those of least hash, so equal for any order and partitioning of the rows; a language
    with fewer texts gives all it has, and every language one at least. Copies count once.
    """
    usable = docs.select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), "doc_id"
    ).filter(F.col("lang").isNotNull() & has_letter(F.col("text")) & (remainder(F.col("doc_id")) != 1))
    usable = usable.select("lang", "text", F.xxhash64("text").alias("h"))
    distinct = usable.select("lang", "h").distinct()
    number = usable.select("lang").distinct().count()
    quota = max(most // max(number, 1), 1)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    # Written, so that Spark knows how small it is before it plans to send the texts.
    chosen = stored(distinct.withColumn("rank", rank).filter(F.col("rank") <= quota).select("lang", "h"), "sample")
    return usable.join(chosen, ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))


def learn(docs: DataFrame, most: int = SAMPLE, landmarks: int = LANDMARKS) -> Model:
    """The model of a sample of the labelled texts (see `sample`) with landmarks of every language among it.

    What reaches the driver is a row of bits for each text of the sample, however long the text.
    """

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            packed = [row.tobytes() for rows in blocks(texts_of(part.column("text"))) for row in np.packbits(rows, axis=1)]
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), part.column("h"), pa.array(packed, pa.binary())], names=["lang", "h", "bits"]
            )

    found = map_batches(sample(docs, most), bits, "lang string, h long, bits binary").toArrow().sort_by(
        [("lang", "ascending"), ("h", "ascending")]
    )
    labels = found.column("lang").to_pylist()
    packed = np.frombuffer(b"".join(found.column("bits").to_pylist()), np.uint8).reshape(len(labels), _BUCKETS // 8)
    share = max(landmarks // max(len(set(labels)), 1), 1)
    seen: dict[str, int] = {}
    marks = []
    for number, label in enumerate(labels):
        seen[label] = seen.get(label, 0) + 1
        if seen[label] <= share:
            marks.append(number)
    return fit(packed, labels, np.array(marks, int))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row of ``docs`` (``doc_id``, ``text``).

    Every whole text is scored. ``score`` is half of one more than the winning regression's value,
    kept within 0 and 1; of equal values the first language in order wins. A text that is NULL,
    empty or has no letter is ``und`` with score 0, as is every text where nothing could be learned.
    A row without an id is not held out. Repeated rows score alike; an empty table gives no rows;
    other columns are left out.
    """
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(
        doc_id.alias("doc_id"), F.coalesce(remainder(doc_id) == 1, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"), has_letter(F.col("text")).alias("lettered"),
    )
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights))  # buckets times languages

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = Model(*sent.value)
        for part in slices(batches, "text"):
            count = part.num_rows
            lettered = part.column("lettered")
            if here.languages:
                values = np.concatenate([here.scores(rows) for rows in blocks(texts_of(part.column("text")))])
                best = values.argmax(axis=1)
                score = np.clip((1 + values[np.arange(count), best].astype(np.float64)) / 2, 0, 1)
                named = pa.array(here.languages, pa.string()).take(pa.array(best))
            else:
                score, named = np.zeros(count), pa.array([UNKNOWN] * count, pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pc.if_else(lettered, named, UNKNOWN),
                 pc.if_else(lettered, pa.array(score), 0.0)], names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return map_batches(rows, work, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """`predict` with a model learned from the rows of ``docs`` (``doc_id``, ``text``, ``lang``) that are not held out."""
    return predict(docs, learn(docs))
