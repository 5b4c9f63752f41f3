"""Words and hashes of a whole Arrow column of texts, as numpy arrays over its UTF-8 bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ODD = 0x9E3779B97F4A7C15
_PIECE = 64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUES = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


@dataclass
class Texts:
    """The bytes of all texts in a row; text ``d`` is ``data[bounds[d]:bounds[d + 1]]``."""

    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Spans:
    """Byte ranges in order of their place; ``first[d]:first[d + 1]`` are the spans of text ``d``."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    first: np.ndarray


def texts_of(column: pa.Array) -> Texts:
    """NULL is the empty text."""
    filled = pc.fill_null(column, "").cast(pa.large_binary())
    bounds = np.frombuffer(filled.buffers()[1], np.int64, len(filled) + 1, filled.offset * 8)
    buffer = filled.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return Texts(data[bounds[0]: bounds[-1]], bounds - bounds[0])


def runs(texts: Texts, inside: np.ndarray) -> Spans:
    """Longest byte ranges where ``inside`` holds; a range never goes on into the next text."""
    size = len(texts.data)
    edges = texts.bounds[1:-1]
    edges = edges[(edges > 0) & (edges < size)]
    before = np.zeros(size + 1, bool)
    before[1:] = inside
    before[edges] = False
    after = np.zeros(size + 1, bool)
    after[:size] = inside
    after[edges] = False
    starts = np.flatnonzero(inside & ~before[:size])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return spans(texts, starts, ends)


def spans(texts: Texts, starts: np.ndarray, ends: np.ndarray) -> Spans:
    first = np.searchsorted(starts, texts.bounds)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    return Spans(starts, ends, text, first)


def space_words(texts: Texts) -> Spans:
    """Words ``[^\\x20\\x09-\\x0D]+``."""
    return runs(texts, ~_SPACE[texts.data])


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _power(base: int, count: int) -> np.ndarray:
    key = str(base)
    if key not in _powers or len(_powers[key]) < count:
        steps = np.full(max(count, 1 << 20), base, np.uint64)
        steps[0] = 1
        _powers[key] = np.cumprod(steps)
    return _powers[key]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """``sums[n]``: the polynomial of the first ``n`` bytes, modulo 2 to the 64th."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * _power(_ODD, len(data) + 1)[: len(data)], out=sums[1:])
    return sums


def inverse_powers(count: int) -> np.ndarray:
    """What turns a difference of sums into a hash that doesn't depend on the range's place."""
    return _power(pow(_ODD, -1, 1 << 64), count + 1)


def codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each byte range a number that equal ranges alone share.

    Ranges are in order and do not overlap. Equality is that of the bytes, whatever they hash to.
    """
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] = 1
    np.add.at(inside, ends, -1)
    kept = data[np.cumsum(inside[:-1], dtype=np.int8) == 1]
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    ranges = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(kept))]
    )
    return ranges.dictionary_encode().indices.to_numpy().astype(np.int64)


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range: polynomials of its pieces by prefix sums, mixed and added up.

    A polynomial modulo a power of two cannot tell certain long words apart; over pieces of 64
    bytes it can, and mixing keeps what holds for one piece from holding for their sum.
    """
    sums, inverse = prefix_sums(data), inverse_powers(len(data))

    def of_piece(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mixed((sums[high] - sums[low]) * inverse[low] + (high - low).astype(np.uint64))

    values = of_piece(starts, ends)
    long = np.flatnonzero(ends - starts > _PIECE)
    if len(long):
        pieces = -(-(ends[long] - starts[long]) // _PIECE)
        first = np.cumsum(pieces) - pieces
        number = np.arange(pieces.sum()) - np.repeat(first, pieces)
        low = np.repeat(starts[long], pieces) + number * _PIECE
        high = np.minimum(low + _PIECE, np.repeat(ends[long], pieces))
        values[long] = np.add.reduceat(mixed(of_piece(low, high) + number.astype(np.uint64) * np.uint64(_ODD)), first)
    return values


def windows(hashes: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    """For each place, a hash of the values at the given offsets; only places where all exist."""
    count = len(hashes) - max(offsets)
    total = np.zeros(max(count, 0), np.uint64)
    if count > 0:
        for number, offset in enumerate(offsets):
            total = mixed(total + hashes[offset: offset + count] + np.uint64(number + 1))
    return total


def whole_windows(words: Spans, span: int) -> np.ndarray:
    """Places where a window of ``span`` words lies in one text."""
    places = np.arange(max(len(words.starts) - span + 1, 0))
    return places[words.text[places] == words.text[places + span - 1]] if len(places) else places
