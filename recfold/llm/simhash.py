"""SimHash near-duplicates: fingerprints, then a bit-sliced comparison within blocks of equal bits.

Two fingerprints with at most three differing bits agree in one of four 16-bit blocks, and in one
of four quarters of the other 48 bits. Those sixteen keys of 28 bits bring every such pair
together; texts of equal fingerprint are one row before that. Within a bucket the fingerprints
are stored as vertical bit planes, 64 of them to a machine word, and one query fingerprint is
held against 64 others at a time: carry-save counters add up the differing bits plane by plane,
and a block is given up once all of its lanes exceed the radius.

A bucket hands on a star of links for each group it connects, not all pairs. Buckets above
``_TILE`` rows are cut into tiles, pairs of pieces, which go to different tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from recfold.llm.components import connected_components
from recfold.llm.rows import HASH, ID, NO_ID, identity, map_batches, slices, stored, without

_TILE = 4096
_SOME_HASHES = 1 << 16
_ROWS = 1 << 17
_PAIRS = 1 << 16
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    """Bits that more than half of the shingle hashes have; no word gives zero."""
    words = text.lower().split()
    count = len(words) - shingle + 1
    if not words:
        return 0
    if count < 1:
        count, pieces = 1, iter([b" ".join(words)])
    else:
        pieces = map(b" ".join, zip(*(words[n:] for n in range(shingle))))
    ones = np.zeros(64, np.int64)
    hashes = map(xxhash.xxh64_intdigest, pieces, repeat(seed))
    for done in range(0, count, _SOME_HASHES):
        values = np.fromiter(hashes, np.dtype("<u8"), min(_SOME_HASHES, count - done))
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """Identity columns and ``fp`` (64 bits as a signed long) of each row of ``docs``.

    ASCII letters are lower-cased, words are runs without ASCII white space, shingles keep
    repeats. A text with fewer words than a shingle is one shingle; NULL and texts without a
    word get zero, which links like any other fingerprint.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            marks = [fingerprint(text or b"", shingle, seed) for text in part.column("text").to_pylist()]
            marks = pa.array(np.array(marks, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), marks], names=[ID, HASH, "fp"])

    rows = docs.select(*identity(), F.col("text").cast("binary").alias("text"))
    return map_batches(rows, work, f"{ID} long, {HASH} long, fp long")


def block_keys(fp: Column) -> Column:
    """The sixteen keys: number of the key, one 16-bit block, a quarter of the other 48 bits."""
    keys = []
    for block in range(4):
        low = fp.bitwiseAND((1 << 16 * block) - 1)
        rest = low.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, 16 * block + 16), 16 * block)) if block < 3 else low
        own = F.shiftrightunsigned(fp, 16 * block).bitwiseAND(0xFFFF)
        for part in range(4):
            some = F.shiftrightunsigned(rest, 12 * part).bitwiseAND(0xFFF)
            number = (block * 4 + part) << 28
            keys.append(F.lit(number).cast("long").bitwiseOR(F.shiftleft(own, 12)).bitwiseOR(some))
    return F.array(*keys)


def bit_planes(marks: np.ndarray) -> np.ndarray:
    """``planes[k, b]``: bit ``k`` of the fingerprints ``64 b`` to ``64 b + 63``, one to a lane."""
    padded = np.zeros(-(-len(marks) // 64) * 64, np.uint64)
    padded[: len(marks)] = marks
    lanes = np.unpackbits(padded.view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
    words = np.packbits(lanes.transpose(2, 0, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(words).view("<u8")[..., 0]


def lanes_within(
    planes: np.ndarray, marks: np.ndarray, block: np.ndarray, wanted: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Which of the lanes ``wanted`` of each ``block`` differ from its query in ``radius`` (0 to 3) bits at most.

    Returns the numbers of the queries with such lanes, and the lanes. ``one`` and ``two`` are
    the bits of all lanes' counters, ``over`` those lanes that have reached four.
    """
    alive = np.arange(len(marks))
    one, two, over = (np.zeros(len(marks), np.uint64) for _ in range(3))
    for plane in range(0, 64, 2):
        differ = [
            planes[k, block] ^ (np.uint64(0) - ((marks >> np.uint64(k)) & np.uint64(1))) for k in (plane, plane + 1)
        ]
        half = differ[0] ^ differ[1]
        carry = (differ[0] & differ[1]) | (half & one)
        one ^= half
        over |= two & carry
        two ^= carry
        if plane % 8 == 6:
            left = (wanted & ~over) != 0
            if left.mean() < 0.75:
                alive, block, marks, wanted = alive[left], block[left], marks[left], wanted[left]
                one, two, over = one[left], two[left], over[left]
                if not len(alive):
                    break
    beyond = over | (np.uint64(0), one & two, two, one | two)[3 - radius]
    found = wanted & ~beyond
    some = found != 0
    return alive[some], found[some]


def _join_labels(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest reachable number of each node, after some more links."""
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        while not np.array_equal(new, jumped := new[new]):
            new = jumped
        if np.array_equal(new, label):
            return new
        label = new


def bucket_links(keys: np.ndarray, marks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars of fingerprints connected within buckets; rows come sorted by key."""
    count = len(keys)
    ends = np.searchsorted(keys, keys, side="right")
    label = np.arange(count)
    planes = bit_planes(marks)
    rows = np.flatnonzero(ends > np.arange(count) + 1)
    first = (rows + 1) // 64
    blocks = (ends[rows] - 1) // 64 - first + 1
    past = np.cumsum(blocks)
    begin = 0
    while begin < len(rows):
        stop = max(begin + 1, int(np.searchsorted(past, (past[begin - 1] if begin else 0) + _PAIRS, side="right")))
        some = slice(begin, stop)
        query = np.repeat(rows[some], blocks[some])
        within = np.arange(len(query)) - np.repeat(np.cumsum(blocks[some]) - blocks[some], blocks[some])
        block = np.repeat(first[some], blocks[some]) + within
        low = np.maximum(query + 1 - 64 * block, 0).astype(np.uint64)
        high = np.minimum(ends[query] - 64 * block, 64).astype(np.uint64)
        wanted = (_ALL << low) & (_ALL >> (np.uint64(64) - high))
        hits, lanes = lanes_within(planes, marks[query], block, wanted, radius)
        if len(hits):
            which, lane = np.nonzero(np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            label = _join_labels(label, query[hits[which]], 64 * block[hits[which]] + lane)
        begin = stop
    linked = np.flatnonzero(label != np.arange(count))
    return marks[linked], marks[label[linked]]


def _compare(radius: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(keys: np.ndarray, marks: np.ndarray) -> pa.RecordBatch:
            pairs = np.stack(bucket_links(keys, marks, radius), axis=1).view(np.int64)
            pairs = np.unique(pairs, axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        keys, marks = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            marks = np.concatenate([marks, batch.column(1).to_numpy().view(np.uint64)])
            if len(keys) >= _ROWS:
                whole = int(np.searchsorted(keys, keys[-1]))
                if whole:
                    yield links(keys[:whole], marks[:whole])
                    keys, marks = keys[whole:], marks[whole:]
        if len(keys):
            yield links(keys, marks)

    return work


def fingerprint_links(marks: DataFrame, radius: int = 3) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints ``fp`` (distinct) within ``radius`` bits, as stars."""
    if not 0 <= radius <= 3:
        raise ValueError("the keys find pairs of up to three differing bits")
    placed = marks.select("fp", F.explode(block_keys(F.col("fp"))).alias("key"))
    large = placed.groupBy("key").count().filter(F.col("count") > _TILE)
    large = large.select("key", F.ceil(F.col("count") / _TILE).cast("int").alias("pieces"))
    own = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    tile = F.transform(
        F.sequence(F.lit(0), F.col("pieces") - 1),
        lambda other: F.least(own, other) * F.col("pieces") + F.greatest(own, other),
    )
    placed = placed.join(large, "key", "left").select(
        "key", "fp", F.explode(F.when(F.col("pieces").isNull(), F.array(F.lit(0))).otherwise(tile)).alias("tile")
    )
    bucket = F.xxhash64("key", "tile")
    dealt = placed.select(bucket.alias("bucket"), "fp").repartition("bucket").sortWithinPartitions("bucket", "fp")
    return map_batches(dealt, _compare(radius), "a long, b long")


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 3, seed: int = 42) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): identity, ``fp``, ``component_id``, ``first_id``, ``first_hash``.

    ``component_id`` is the smallest ``doc_id`` that links reach, NULL if all of them are NULL;
    ``first_id`` and ``first_hash`` are the identity of the row that stands for the component
    (smallest id, NULL last, ties by the text's hash). Equal rows get equal answers; an empty
    table gives none. Other columns are not looked at.
    """
    rows = stored(fingerprints(docs, shingle, seed), "fingerprints")
    no_id = F.col(ID) == NO_ID
    first = F.min(F.struct(no_id.alias("no_id"), F.col(ID).alias("id"), F.col(HASH).alias("hash")))
    classes = stored(rows.groupBy("fp").agg(first.alias("first")), "classes")
    roots = connected_components(fingerprint_links(classes.select("fp"), radius))
    classes = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    firsts = classes.groupBy("root").agg(F.min("first").alias("first"))
    # Written, so that both sides of the last join are dealt anew and Spark can split a hot fingerprint.
    firsts = stored(classes.select("fp", "root").join(firsts, "root").select("fp", "first"), "firsts")
    return rows.join(firsts, "fp").select(
        ID, HASH, "fp",
        F.when(~F.col("first.no_id"), F.col("first.id")).alias("component_id"),
        F.col("first.id").alias("first_id"), F.col("first.hash").alias("first_hash"),
    )


def one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each component: the one that stands for it, once if it is repeated."""
    groups = simhash_components(docs, shingle, radius, seed)
    first = (F.col(ID) == F.col("first_id")) & (F.col(HASH) == F.col("first_hash"))
    decided = groups.groupBy(ID, HASH).agg(F.max(first).alias("stays"), F.count("*").alias("n"))
    decided = stored(decided.filter("not stays or n > 1"), "decided")
    return without(docs, decided.filter("not stays"), decided.filter("stays"))
