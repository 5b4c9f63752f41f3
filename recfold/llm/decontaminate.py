"""Benchmark decontamination by spaced seeds.

A seed is a hash of the tokens at some positions of a window; the positions that its mask leaves
out may differ. Seeds of the test items and of the training texts meet in a join, and each hit is
verified on its diagonal: some ``WINDOW`` aligned tokens (all of a shorter item) must agree in a
share of ``SHARE`` at least. ``MASKS`` together hit every aligned window of 17 to 20 tokens that
``SHARE`` admits, wherever its substitutions are (20 tokens: up to four); for items of 8 to 16 tokens
``SHORT_MASKS`` are added, which hit the rest (tested over all cases of all lengths). Items of fewer
than ``LEAST`` tokens are too short for substitutions: a mask of their own length finds them, and
all tokens must agree.

Training seeds are looked up in a bitmap of fixed size before they leave their task, so that
what is shuffled follows the hits and not the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from recfold.llm.rows import HASH, ID, bitmap, identity, in_bitmap, map_batches, slices, stored, without
from recfold.llm.text_arrays import Spans, hash_ranges, mixed, runs, texts_of

MASKS = ("1101111", "1100010111", "101000110011")
SHORT_MASKS = ("111111", "11110011", "1110001011")
SHORT = 17  # items of fewer tokens are looked for by the short masks, too
WINDOW = 20
SHARE = 0.8
LEAST = 8
_OFFSETS = [tuple(n for n, on in enumerate(mask) if on == "1") for mask in MASKS + SHORT_MASKS]
_WHOLE = [tuple(range(size)) for size in range(1, LEAST)]  # numbered behind the masks, by length
_SPAN = max(map(len, MASKS + SHORT_MASKS))
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def tokens(column: pa.Array) -> tuple[Spans, np.ndarray]:
    """Token places and hashes: runs of letters and digits of the lower-cased text; NULL is empty."""
    texts = texts_of(pc.utf8_lower(column))
    words = runs(texts, _WORD[texts.data])
    return words, hash_ranges(texts.data, words.starts, words.ends)


def seeds(
    hashes: np.ndarray, owner: np.ndarray, lengths: tuple[int, ...]
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each mask: its number, places whose window lies in one text, and the seeds there.

    ``lengths`` are those below ``LEAST`` whose masks are wanted as well.
    """
    wanted = [*enumerate(_OFFSETS), *((len(_OFFSETS) + size, _WHOLE[size - 1]) for size in lengths)]
    for number, offsets in wanted:
        count = len(hashes) - offsets[-1]
        if count <= 0:
            continue
        total = np.full(count, number + 1, np.uint64)
        for offset in offsets:
            total = (total + hashes[offset: offset + count]) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
        places = np.flatnonzero(owner[:count] == owner[offsets[-1]:])
        yield number, places, mixed(total[places])


def _benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``item`` (smallest id of equal token sequences), ``n_items``, ``item_tokens``; those without a token left out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words, hashes = tokens(part.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(words.first, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["item_id", "item_tokens"])

    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    items = map_batches(rows, work, "item_id long, item_tokens array<long>")
    return (
        items.filter(F.size("item_tokens") > 0)
        .groupBy("item_tokens")
        .agg(F.min("item_id").alias("item_id"), F.count("*").alias("n_items"))
        .select(F.xxhash64("item_tokens").alias("item"), "item_id", "n_items", "item_tokens")
    )


def _item_seeds(items: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, values = batch.column("item").to_numpy(), batch.column("item_tokens")
            flat = values.flatten().to_numpy().view(np.uint64)
            sizes = np.array(values.value_lengths().to_pylist(), np.int64)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            first = np.cumsum(sizes) - sizes
            for number, places, made in seeds(flat, owner, tuple(range(1, LEAST))):
                size = sizes[owner[places]]
                if number < len(MASKS):
                    some = size >= LEAST
                elif number < len(_OFFSETS):
                    some = (size >= LEAST) & (size < SHORT)
                else:
                    some = size == number - len(_OFFSETS)
                places, made = places[some], made[some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made.view(np.int64)), pa.array(names[owner[places]]),
                     pa.array((places - first[owner[places]]).astype(np.int32))],
                    names=["seed", "item", "item_at"],
                )

    return map_batches(items.select("item", "item_tokens"), work, "seed long, item long, item_at int")


def _regions(docs: DataFrame, seed_bits: np.ndarray, lengths: tuple[int, ...]) -> DataFrame:
    """Stretches of texts around possible hits, with their tokens, and the hits in them."""
    sent = docs.sparkSession.sparkContext.broadcast(seed_bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for part in slices(batches, "text"):
            words, hashes = tokens(part.column("text"))
            found_at, found = [], []
            for number, places, made in seeds(hashes, words.text, lengths):
                some = np.flatnonzero(in_bitmap(bits, made))
                if number >= len(_OFFSETS):  # all tokens agree or none: the first place in a text will do
                    pairs = np.stack([words.text[places[some]], made[some].view(np.int64)])
                    some = some[np.sort(np.unique(pairs, axis=1, return_index=True)[1])]
                found_at.append(places[some])
                found.append(made[some])
            if not found or not sum(map(len, found)):
                continue
            at, made = np.concatenate(found_at), np.concatenate(found)
            order = np.argsort(at, kind="stable")
            at, made = at[order], made[order]
            owner = words.text[at]
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(at) > 2 * WINDOW + _SPAN) | (np.diff(owner) > 0)
            begins = np.flatnonzero(new)
            ends = np.append(begins[1:], len(at))
            text = owner[begins]
            low = np.maximum(at[begins] - WINDOW, words.first[text])
            high = np.minimum(at[ends - 1] + _SPAN + WINDOW, words.first[text + 1])
            sizes = high - low
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            inside = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - low, sizes)
            hits = np.concatenate([[0], np.cumsum(ends - begins)])
            region = np.repeat(np.arange(len(begins)), ends - begins)
            as_list = lambda where, values: pa.ListArray.from_arrays(pa.array(where, pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(text)), part.column(1).take(pa.array(text)),
                 pa.array((low - words.first[text]).astype(np.int64)),
                 as_list(bounds, hashes[inside].view(np.int64)),
                 as_list(hits, (at - low[region]).astype(np.int32)), as_list(hits, made.view(np.int64))],
                names=[ID, HASH, "begin", "region", "at", "seed"],
            )

    rows = docs.select(*identity(), F.col("text").cast("string").alias("text"))
    return map_batches(
        rows, work, f"{ID} long, {HASH} long, begin long, region array<long>, at array<int>, seed array<long>"
    )


def _verified(candidates: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(n) for n in range(5)]
            begin, diagonal = batch.column("begin").to_numpy(), batch.column("diagonal").to_numpy()
            regions, items = batch.column("region"), batch.column("item_tokens")
            keep, places, sizes, same = [], [], [], []
            for n in range(batch.num_rows):
                region, item = regions[n].values.to_numpy(), items[n].values.to_numpy()
                shift, size = int(diagonal[n]), min(WINDOW, len(item))
                low, high = max(0, -shift), min(len(item), len(region) - shift)
                if high - low < size:
                    continue
                sums = np.concatenate([[0], np.cumsum(region[low + shift: high + shift] == item[low:high])])
                agree = sums[size:] - sums[:-size]
                best = int(agree.argmax())
                if agree[best] >= (SHARE * size if size >= LEAST else size):
                    keep.append(n)
                    places.append(int(begin[n]) + shift + low + best)
                    sizes.append(size)
                    same.append(int(agree[best]))
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(c.take(rows) for c in columns[:4]), pa.array(places, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(same, pa.int64())],
                names=[ID, HASH, "item_id", "n_items", "token_at", "n_tokens", "n_same"],
            )

    rows = candidates.select(ID, HASH, "item_id", "n_items", "begin", "diagonal", "region", "item_tokens")
    schema = f"{ID} long, {HASH} long, item_id long, n_items long, token_at long, n_tokens long, n_same long"
    return map_batches(rows, work, schema)


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Verified overlaps of ``docs`` (``doc_id``, ``text``) with ``benchmark`` (``item_id``, ``text``).

    One row per document and item: identity of the document, ``item_id`` (the smallest of items
    with equal tokens, ``n_items`` of them), ``token_at`` (place of the best window in the text,
    the first of the best), ``n_tokens`` and ``n_same`` (its tokens, those that agree). Case and
    punctuation do not count. Items under eight tokens are found where all their tokens stand in a
    row. NULL and empty texts and empty tables give no rows; repeated documents are one document.
    Other columns are not looked at.
    """
    items = stored(_benchmark_items(benchmark), "items")
    item_seeds = stored(_item_seeds(items), "item_seeds")
    size = F.size("item_tokens")
    lengths = tuple(sorted(row[0] for row in items.filter(size < LEAST).select(size).distinct().collect()))  # seven at most
    regions = stored(_regions(docs, bitmap(item_seeds.select(F.col("seed").alias("key"))), lengths), "regions")
    hits = regions.select(ID, HASH, "begin", F.explode(F.arrays_zip("at", "seed")).alias("hit"))
    hits = hits.select(ID, HASH, "begin", F.col("hit.at").alias("at"), F.col("hit.seed").alias("seed"))
    found = hits.join(item_seeds, "seed").select(
        ID, HASH, "begin", "item", (F.col("at") - F.col("item_at")).alias("diagonal")
    ).distinct()
    candidates = found.join(regions.select(ID, HASH, "begin", "region"), [ID, HASH, "begin"]).join(items, "item")
    best = F.max(F.struct("n_same", (-F.col("token_at")).alias("back"), "n_tokens")).alias("best")
    return _verified(candidates).groupBy(ID, HASH, "item_id", "n_items").agg(best).select(
        ID, HASH, "item_id", "n_items", (-F.col("best.back")).alias("token_at"),
        F.col("best.n_tokens").alias("n_tokens"), F.col("best.n_same").alias("n_same"),
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` less every row that overlaps an item; NULL and empty texts stay."""
    return without(docs, stored(overlaps(docs, benchmark).select(ID, HASH).distinct(), "contaminated"))
