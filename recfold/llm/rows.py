"""Helpers shared by the corpus operators: row identity, slices of Arrow batches, scratch tables."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from recfold.sources.storage import materialise, scratch_dir

ID, HASH = "__recfold_id", "__recfold_hash"
_SLICE_BYTES = 1 << 20
NO_ID = -(1 << 63)
_LEAST_BITS, _MOST_BITS = 16, 28
_PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()

Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def map_batches(df: DataFrame, work: Work, schema: str) -> DataFrame:
    """``mapInArrow`` on executors that need not have this library: Spark hands them its files."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        archive = os.path.join(tempfile.mkdtemp(), "recfold.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(_PACKAGE.rglob("*.py")):
                out.write(path, path.relative_to(_PACKAGE.parent))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return df.mapInArrow(work, schema)


def identity() -> list[Column]:
    """Two columns, never NULL, that are equal for rows of equal ``doc_id`` and ``text`` only.

    NULL ids and NULL texts compare as values here, so that plain equality joins keep them.
    """
    doc_id = F.col("doc_id").cast("long")
    return [
        F.coalesce(doc_id, F.lit(NO_ID)).alias(ID),
        F.xxhash64("text", F.col("text").isNull(), doc_id.isNull()).alias(HASH),
    ]


def with_identity(docs: DataFrame) -> DataFrame:
    return docs.select("*", *identity())


def without(docs: DataFrame, removed: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Rows of ``docs`` whose identity is not in ``removed``; of those with one in ``repeated``, one each.

    A bitmap of these identities clears most other rows where they are read; only the rest are sent
    to where the identities are.
    """
    rows = with_identity(docs)
    doubtful = removed.select(ID, HASH) if repeated is None else removed.select(ID, HASH).union(repeated.select(ID, HASH))
    sent = docs.sparkSession.sparkContext.broadcast(bitmap(doubtful.select(F.col(HASH).alias("key"))))

    def some(in_doubt: bool) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = in_bitmap(sent.value, batch.column(HASH).to_numpy().view(np.uint64))
                yield batch.filter(pa.array(found == in_doubt))

        return map_batches(rows, work, rows.schema)

    held = some(True)
    if repeated is not None:
        held = held.dropDuplicates([ID, HASH])
    held = held.join(removed.select(ID, HASH), [ID, HASH], "left_anti")
    return some(False).select(*own_columns(docs)).union(held.select(*own_columns(docs)))


def own_columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{name}`") for name in df.columns]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read back: survives lost executors."""
    return materialise(df, f"{scratch_dir(df.sparkSession)}/{name}")


def bitmap(keys: DataFrame) -> np.ndarray:
    """Two bits for each hash in the column ``key``, among a thousand bits a key or more: 32 MB at most.

    Of foreign hashes both bits let a few in a million through, with ten million keys half a per
    cent, beyond that ever more; callers are right whatever passes.
    """
    size = min(max((1024 * keys.count()).bit_length(), _LEAST_BITS), _MOST_BITS)
    mask = (1 << size) - 1
    places = F.explode(F.array(
        F.col("key").bitwiseAND(mask), F.shiftrightunsigned("key", size).bitwiseAND(mask)
    )).alias("place")
    words = keys.select(places).groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")
    ).toPandas()  # at most 2 ** (_MOST_BITS - 6) rows
    bits = np.zeros(1 << (size - 6), np.int64)
    bits[words["word"]] = words["bits"]
    return bits.view(np.uint64)


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where both bits of a hash are set: everywhere that it is among the keys, and rarely elsewhere."""
    size = np.uint64(len(bits).bit_length() + 5)
    mask = np.uint64((1 << int(size)) - 1)

    def is_set(at: np.ndarray) -> np.ndarray:
        return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    found = is_set(keys & mask)
    some = np.flatnonzero(found)
    found[some] = is_set((keys[some] >> size) & mask)
    return found


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = _SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``size`` bytes of ``column``, or one row that is longer.

    Every text stays whole; only the number of rows worked on at once is bounded.
    """
    for batch in batches:
        start, held = 0, 0
        for row, length in enumerate(_lengths(batch.column(column))):
            if held and held + length > size:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += length
        if start < batch.num_rows:
            yield batch.slice(start)


def _lengths(column: pa.Array) -> list[int]:
    return pc.fill_null(pc.binary_length(column), 0).to_pylist()
