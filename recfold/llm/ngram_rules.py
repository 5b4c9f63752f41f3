"""Quality rules: plain counts of a text, and a hashed n-gram log-likelihood ratio.

Words and pairs of adjacent words are hashed to ``BUCKETS`` buckets. Two multinomials over them,
one of trusted target texts and one of the raw corpus, give each n-gram a log ratio, and a text
the mean over its n-grams. Every text is held against the same fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recfold.llm.rows import ID, bitmap, identity, in_bitmap, map_batches, slices
from recfold.llm.text_arrays import (
    Spans, Texts, codes, hash_ranges, mixed, runs, space_words, spans, texts_of, whole_windows, windows,
)

BUCKETS = 1 << 16
THRESHOLD = -0.1
_SMOOTHING = 0.5
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def grams(texts: Texts, words: Spans, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every word and pair of words."""
    places = whole_windows(words, 2)
    pairs = windows(hashes, (0, 1))[places] if len(places) else np.zeros(0, np.uint64)
    owner = np.concatenate([words.text, words.text[places]])
    values = np.concatenate([mixed(hashes), pairs])
    return owner, (values >> np.uint64(48)).astype(np.int64)


def _coded_words(texts: Texts) -> tuple[Spans, np.ndarray, np.ndarray]:
    """Words, for each a number that equal words alone share, and a hash."""
    words = space_words(texts)
    where = texts.data, words.starts, words.ends
    return words, codes(*where), hash_ranges(*where)


def _triples(numbers: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For windows of three numbers at these places, a number that equal windows alone share."""
    size = int(numbers.max(initial=0)) + 1
    pairs = np.unique(numbers[places] * size + numbers[places + 1], return_inverse=True)[1]
    return pairs * size + numbers[places + 2]


def _repeats(owner: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For values of one text each: is there an equal one in the text, and is there an earlier one."""
    order = np.lexsort((np.arange(len(values)), values, owner))
    same = (values[order][1:] == values[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    again, earlier = np.zeros(len(values), bool), np.zeros(len(values), bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    earlier[order[1:]] = same
    return again, earlier


def counts(texts: Texts, words: Spans, numbers: np.ndarray) -> dict[str, np.ndarray]:
    number = len(texts)
    data, bounds = texts.data, texts.bounds

    def per_text(flag: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return sums[bounds[1:]] - sums[bounds[:-1]]

    inside = np.zeros(len(data) + 1, np.int8)
    inside[words.starts] += 1
    np.add.at(inside, words.ends, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8) == 1
    lines = runs(texts, data != 10)
    first_word = np.searchsorted(words.starts, lines.starts)
    filled = np.append(words.starts, len(data) + 1)[first_word] < lines.ends
    lines = spans(texts, lines.starts[filled], lines.ends[filled])
    _, earlier = _repeats(lines.text, codes(data, lines.starts, lines.ends))
    covered = np.zeros(len(words.starts), bool)
    places = whole_windows(words, 3)
    if len(places):
        again, _ = _repeats(words.text[places], _triples(numbers, places))
        for offset in range(3):
            covered[places[again] + offset] = True
    return {
        "n_words": np.diff(words.first),
        "word_chars": per_text(inside & ((data & 0xC0) != 0x80)),
        "n_symbols": per_text(_SYMBOL[data]),
        "n_dup_lines": np.bincount(lines.text[earlier], minlength=number),
        "n_repeat_words": np.bincount(words.text[covered], minlength=number),
    }


def _trusted_rows(rows: DataFrame, trusted: DataFrame) -> DataFrame:
    """Texts of ``rows`` whose id is trusted: a bitmap of ids keeps most others out of the shuffle."""
    ids = trusted.select(F.col("doc_id").cast("long").alias(ID)).filter(F.col(ID).isNotNull())
    sent = rows.sparkSession.sparkContext.broadcast(bitmap(ids.select(F.xxhash64(ID).alias("key"))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            yield batch.filter(pa.array(in_bitmap(sent.value, keys)))

    likely = map_batches(
        rows.select(ID, "text", F.xxhash64(ID).alias("key")), work, f"{ID} long, text string, key long"
    )
    # Always a shuffle, of the same share of the texts at every size.
    return likely.join(ids.hint("merge"), ID, "left_semi")


def _bucket_counts(rows: DataFrame) -> np.ndarray:
    """How often each bucket is met in ``text``: each task sends its counts, 65,536 sums come back."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, np.int64)
        for part in slices(batches, "text"):
            texts = texts_of(part.column("text"))
            words = space_words(texts)
            hashes = hash_ranges(texts.data, words.starts, words.ends)
            sums += np.bincount(grams(texts, words, hashes)[1], minlength=BUCKETS)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["bucket", "met"])

    met = map_batches(rows.select("text"), work, "bucket long, met long")
    met = met.groupBy("bucket").agg(F.sum("met").alias("met")).toPandas()
    sums = np.zeros(BUCKETS)
    sums[met["bucket"]] = met["met"]
    return sums


def log_ratios(docs: DataFrame, trusted: DataFrame) -> np.ndarray:
    """Log ratio of target to raw share for each bucket, counted over every row of ``docs``.

    ``trusted`` has the ids (``doc_id``) of the target texts. Without any target text all ratios
    are zero.
    """
    rows = docs.select(identity()[0], F.col("text").cast("string").alias("text"))
    target = _bucket_counts(_trusted_rows(rows, trusted))
    if not target.sum():
        return np.zeros(BUCKETS)
    raw = _bucket_counts(rows)

    def shares(values: np.ndarray) -> np.ndarray:
        return np.log((values + _SMOOTHING) / (values.sum() + _SMOOTHING * BUCKETS))

    return shares(target) - shares(raw)


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept`` and ``log_ratio`` of every row of ``docs``.

    ``kept`` is false for a text that fails the plain rules, else whether its mean log ratio is
    at least the threshold. NULL counts as the empty text, whose ratio is 0 and which fails the
    plain rules. Rows are judged one by one, repeated ones alike; an empty table gives no rows.
    Other columns are not looked at.
    """
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, trusted))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = texts_of(part.column("text"))
            words, numbers, hashes = _coded_words(texts)
            found = counts(texts, words, numbers)
            owner, bucket = grams(texts, words, hashes)
            total = np.bincount(owner, weights=ratios.value[bucket], minlength=len(texts))
            ratio = total / np.maximum(np.bincount(owner, minlength=len(texts)), 1)
            failed = (found["n_words"] < 50) | (100 * found["n_repeat_words"] > 50 * found["n_words"])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(found[name].astype(np.int64)) for name in COUNTS), pa.array(failed),
                 pa.array(~failed & (ratio >= threshold)), pa.array(ratio)],
                names=["doc_id", *COUNTS, "base_failed", "kept", "log_ratio"],
            )

    schema = ", ".join(["doc_id long", *(f"{name} long" for name in COUNTS), "base_failed boolean", "kept boolean"])
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, work, f"{schema}, log_ratio double")
