"""Byte-pair encoding by a deterministic automaton over tokens, and decoding by its arc labels.

The automaton reads tokens: it accepts a sequence exactly if encoding the bytes that the sequence
spells gives that sequence. It starts as one state with an arc for each byte, and each merge of
``u`` and ``v`` into ``w``, in order of rank, adds a gadget: where ``u`` then ``v`` was a path,
an arc ``w`` leads from its start to its end; the state after ``u`` becomes one of its own that
has lost its arc ``v``. The target of an arc depends on its label only, so the automaton is a
table: the state after each token, and whether a state has an arc for a token. Equal states and
equal columns fold into one each.

A word is encoded by one pass over its bytes. Each prefix is spelled by exactly one accepted path,
so a place needs only the last token of that path: it is the token that ends there and for which
the state reached where it begins has an arc.
"""

from __future__ import annotations

import bisect
import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from recfold.llm.rows import map_batches, slices
from recfold.llm.text_arrays import inverse_powers, prefix_sums

# Fixed value: the pattern that splits text before the merges, with the white space that the
# tokenizer library means by \s spelled out.
SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
_SLICE = 2 << 20  # bytes of text whose words are looked up once
_CACHED = 120_000
_CACHED_CHARS = 64
_TOGETHER = 24
_AT_ONCE = 50_000
_SHIFT = 44
_SLOTS = 1 << (64 - _SHIFT)
_compiled: dict[str, Automaton] = {}
_sent: dict[tuple[str, str, bool], object] = {}


class _Recent:
    """Encoded pieces of text that were used lately.

    When half of the room is taken, what is there becomes the old half and what was old goes;
    pieces used again move over, so frequent ones stay and memory is bounded.
    """

    def __init__(self) -> None:
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def known(self, pieces: set[str]) -> dict[str, bytes]:
        return {p: half[p] for half in (self.old, self.new) for p in pieces & half.keys()}

    def keep(self, used: dict[str, bytes]) -> None:
        short = dict(islice(((p, ids) for p, ids in used.items() if len(p) <= _CACHED_CHARS), _CACHED // 2))
        if len(self.new) + len(short.keys() - self.new.keys()) > _CACHED // 2:
            self.old, self.new = self.new, {}
        self.new.update(short)


@dataclass
class Labels:
    """What decoding needs: the bytes on the arc of each token."""

    labels: list[bytes]

    def decode(self, ids: bytes) -> str:
        labels = self.labels
        return b"".join([labels[n] for n in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@dataclass
class Automaton:
    labels: list[bytes]
    state: list[int]
    group: list[int]
    arcs: bytes
    width: int
    special: dict[str, int]
    ids: dict[bytes, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.ids = self.ids or {label: n for n, label in enumerate(self.labels) if self.state[n] >= 0}
        self.longest = max(map(len, self.ids), default=0)
        self.arrays = None
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.words, self.chunks = _Recent(), _Recent()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("words", "chunks", "cut", "arrays")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def follows(self, token: int, after: int) -> int:
        """Whether the state after a token has an arc for the other."""
        column = self.group[token]
        return self.arcs[self.state[after] * self.width + (column >> 3)] >> (column & 7) & 1

    def encode_word(self, word: bytes) -> list[int]:
        ids, longest, state, group, arcs, width = (
            self.ids, self.longest, self.state, self.group, self.arcs, self.width
        )
        last: list[int] = []
        rows: list[int] = []
        for end in range(1, len(word) + 1):
            for begin in range(max(0, end - longest), end):
                token = ids.get(word[begin:end])
                if token is None:
                    continue
                if begin:
                    column = group[token]
                    if not arcs[rows[begin - 1] + (column >> 3)] >> (column & 7) & 1:
                        continue
                last.append(token)
                rows.append(state[token] * width)
                break
        path, end = [], len(word)
        while end:
            path.append(last[end - 1])
            end -= len(self.labels[path[-1]])
        return path[::-1]

    def _table(self) -> tuple[np.ndarray, ...]:
        """The automaton as arrays, with token ids found by a hash of their bytes."""
        if self.arrays is None:
            tokens = np.fromiter(self.ids.values(), np.int64, len(self.ids))
            ends = np.cumsum([len(label) for label in self.ids], dtype=np.int64)
            data = np.frombuffer(b"".join(self.ids), np.uint8)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            keys = np.zeros(_SLOTS, np.uint64)
            held = np.full(_SLOTS, -1)
            for key, token in zip(_labels_hashed(data, starts, ends).tolist(), tokens.tolist(), strict=True):
                slot = key >> _SHIFT
                while held[slot] >= 0:
                    slot = (slot + 1) % _SLOTS
                keys[slot], held[slot] = key, token
            arcs = np.frombuffer(self.arcs, np.uint8)
            spans = np.array([len(label) for label in self.labels], np.int64)
            self.arrays = keys, held, np.array(self.state), np.array(self.group), arcs, spans
        return self.arrays

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """``encode_word`` for many words at once: the same transitions, one place of all words at a time."""
        keys, held, state, group, arcs, spans = self._table()
        order = sorted(range(len(words)), key=lambda n: -len(words[n]))
        sizes = np.array([len(words[n]) for n in order], np.int64)
        count, longest = len(order), int(sizes[0]) if order else 0
        data = np.frombuffer(b"".join([words[n] for n in order]), np.uint8)
        first = np.cumsum(sizes) - sizes
        sums, inverse = prefix_sums(data), inverse_powers(len(data))
        last = np.full((longest, count), -1, np.int32)
        row = np.zeros((longest, count), np.int64)
        for end in range(1, longest + 1):
            active = int(np.searchsorted(-sizes, -end, side="right"))
            for begin in range(max(0, end - self.longest), end):
                left = np.flatnonzero(last[end - 1, :active] < 0)
                if not len(left):
                    break
                from_ = first[left] + begin
                key = (sums[first[left] + end] - sums[from_]) * inverse[from_]
                slot = (key >> np.uint64(_SHIFT)).astype(np.int64)
                token = held[slot]
                other = np.flatnonzero((token >= 0) & (keys[slot] != key))
                while len(other):
                    slot[other] = (slot[other] + 1) % _SLOTS
                    token[other] = held[slot[other]]
                    other = other[(token[other] >= 0) & (keys[slot[other]] != key[other])]
                some = token >= 0
                left, token = left[some], token[some]
                if begin:
                    column = group[token]
                    has = (arcs[row[begin - 1, left] + (column >> 3)] >> (column & 7)) & 1
                    left, token = left[has == 1], token[has == 1]
                last[end - 1, left] = token
                row[end - 1, left] = state[token] * self.width
        # All paths are traced back together, a token of each word at a time.
        steps, end, left = [], sizes.copy(), np.flatnonzero(sizes)
        number = np.zeros(count, np.int64)
        while len(left):
            token = last[end[left] - 1, left]
            steps.append((left, token))
            number[left] += 1
            end[left] -= spans[token]
            left = left[end[left] > 0]
        ends = np.cumsum(number)
        ids = np.zeros(int(number.sum()), "<u4")
        for step, (left, token) in enumerate(steps):
            ids[ends[left] - 1 - step] = token
        joined, ends = ids.tobytes(), (4 * ends).tolist()
        results = [b""] * count
        for place, begin, end in zip(order, [0, *ends], ends):
            results[place] = joined[begin:end]
        return results

    def _encoded(self, words: set[str]) -> dict[str, bytes]:
        """The ids of each word; words that are not remembered are encoded together."""
        found = self.words.known(words)
        new = sorted(words - found.keys(), key=len)
        short = bisect.bisect_right(new, _TOGETHER, key=len)
        for begin in range(0, short, _AT_ONCE):
            some = new[begin:min(short, begin + _AT_ONCE)]
            found.update(zip(some, self.encode_words([word.encode() for word in some]), strict=True))
        for word in new[short:]:
            ids = self.encode_word(word.encode())
            found[word] = struct.pack(f"<{len(ids)}I", *ids)
        self.words.keep(found)
        return found

    def _pieces(self, text: str) -> list[str]:
        """The words of a text, and the added tokens in it, in order."""
        pieces, begin = [], 0
        for found in self.cut.finditer(text) if self.cut else ():
            pieces += [*SPLIT.findall(text[begin:found.start()]), found.group()]
            begin = found.end()
        return pieces + SPLIT.findall(text[begin:])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian 32-bit numbers.

        A single space between two other characters always begins a word, so chunks between
        such spaces are looked up whole; a text with other white space runs beside a space, or
        with an added token, is split by the pattern throughout.
        """
        parts = [[text] if self.cut and self.cut.search(text) else text.split(" ") for text in texts]
        wanted = set().union(*(islice(part, 1, None) for part in parts))
        chunks = self.chunks.known(wanted)
        new = wanted - chunks.keys()
        loose = {chunk for chunk in new if not chunk or chunk[0].isspace() or chunk[-1].isspace()}
        heads = []
        for n, (text, part) in enumerate(zip(texts, parts, strict=True)):
            head = part[0]
            if len(part) > 1 and (not head or head[-1].isspace() or not loose.isdisjoint(part)):
                head, parts[n] = text, [text]
            heads.append(self._pieces(head))
        split = {chunk: SPLIT.findall(" " + chunk) for chunk in new - loose}
        words = self._encoded(set().union(*heads, *split.values()) - self.special.keys())
        words.update((token, struct.pack("<I", number)) for token, number in self.special.items())
        chunks.update((chunk, b"".join([words[word] for word in pieces])) for chunk, pieces in split.items())
        self.chunks.keep(chunks)
        return [
            b"".join([*map(words.__getitem__, head), *map(chunks.__getitem__, islice(part, 1, None))])
            for head, part in zip(heads, parts, strict=True)
        ]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        return Labels(self.labels).decode(ids)


def _labels_hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = prefix_sums(data)
    return (sums[ends] - sums[starts]) * inverse_powers(len(data))[starts]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, and back.

    Printable bytes stand for themselves, the others for the letters from 256 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [n for n in range(256) if n not in plain]
    return {chr(n): n for n in plain} | {chr(256 + k): n for k, n in enumerate(others)}


def build(vocab: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int]) -> Automaton:
    """Apply the gadget of each merge in turn, then fold equal states and columns."""
    letters = byte_letters()
    size = max([*vocab.values(), *special.values()], default=-1) + 1
    words = -(-size // 64)
    lost = np.zeros((size, words), np.uint64)  # lost[t]: tokens for which the state after t has no arc
    known = {vocab[letter] for letter in letters if letter in vocab}
    made = max(known, default=-1) + 1

    def bit(token: int) -> tuple[int, np.uint64]:
        return token >> 6, np.uint64(1 << (token & 63))

    for left, right in merges:
        u, v, w = vocab[left], vocab[right], vocab[left + right]
        made = max(made, w + 1)
        (iu, bu), (iv, bv), (iw, bw) = bit(u), bit(v), bit(w)
        without = np.flatnonzero(lost[:made, iu] & bu)  # states without an arc u get none for w
        lost[without, iw] |= bw
        if u in known and v in known and not lost[u, iv] & bv:
            known.add(w)
        else:
            lost[:, iw] |= bw  # no path u, v is left: w is never made
        lost[w] = lost[v]
        lost[u, iv] |= bv
        if u == v:
            lost[u, iw] |= bw

    draw = np.random.Generator(np.random.PCG64(7))
    factors = draw.integers(1, 1 << 63, words, dtype=np.uint64) | np.uint64(1)
    marks = np.concatenate([(lost[n: n + 512] * factors).sum(1, dtype=np.uint64) for n in range(0, size, 512)] or [[]])
    _, first, state = np.unique(marks, return_index=True, return_inverse=True)
    states = lost[first]
    del lost
    factors = draw.integers(1, 1 << 63, len(states), dtype=np.uint64) | np.uint64(1)
    places = np.arange(64, dtype=np.uint64)
    columns = np.zeros(words * 64, np.uint64)
    for word in range(words):
        columns[word * 64: word * 64 + 64] = (
            ((states[:, word, None] >> places) & np.uint64(1)) * factors[:, None]
        ).sum(0, dtype=np.uint64)
    _, sample, group = np.unique(columns[:size], return_index=True, return_inverse=True)
    has = np.zeros((len(states), len(sample)), bool)
    for column, token in enumerate(sample):
        word, mask = bit(int(token))
        has[:, column] = (states[:, word] & mask) == 0
    packed = np.packbits(has, axis=1, bitorder="little")
    labels = [b""] * size
    for token, number in vocab.items():
        labels[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    for token, number in special.items():
        labels[number] = token.encode()
    state = [int(s) if n in known else -1 for n, s in enumerate(state)]
    return Automaton(labels, state, group.tolist(), packed.tobytes(), packed.shape[1], special)


def compile_file(path: str) -> Automaton:
    """The automaton of a byte-level BPE file of the tokenizers library; compiled once per process."""
    if path not in _compiled:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        special = {token["content"]: token["id"] for token in content["added_tokens"]}
        _compiled[path] = build(model["vocab"], merges, special)
    return _compiled[path]


def _shared(spark: SparkSession, path: str, labels_only: bool):
    """The automaton, or its labels, as a broadcast; its size follows the vocabulary file, not the data."""
    key = spark.sparkContext.applicationId, path, labels_only
    if key not in _sent:
        automaton = compile_file(path)
        _sent[key] = spark.sparkContext.broadcast(Labels(automaton.labels) if labels_only else automaton)
    return _sent[key]


def _with_columns(df: DataFrame, path: str, source: str, made: dict[str, str]) -> DataFrame:
    """``df`` with columns made from ``source``, named after what they hold; there ones are replaced."""
    automaton = _shared(df.sparkSession, path, list(made) == ["decoded"])
    others = [(n, f) for n, f in enumerate(df.schema.fields) if f.name.lower() not in made]
    names = [*(f.name for _, f in others), *made]
    schema = ", ".join([
        *(f"`{f.name}` {f.dataType.simpleString()}" for _, f in others), *(f"{name} {kind}" for name, kind in made.items())
    ])
    at = df.columns.index(source)
    kinds = {"binary": pa.binary(), "string": pa.string(), "bigint": pa.int64()}
    types = {name: kinds[kind] for name, kind in made.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = automaton.value
        for part in slices(batches, source, _SLICE):
            column = part.column(at)
            found = {}
            if list(types) == ["decoded"]:
                found["token_ids"] = [ids or b"" for ids in column.to_pylist()]
            else:
                found["token_ids"] = table.encode_all([text or "" for text in column.to_pylist()])
            if "n_tokens" in types:
                found["n_tokens"] = [len(ids) // 4 for ids in found["token_ids"]]
            if "decoded" in types:
                found["decoded"] = [table.decode(ids) for ids in found["token_ids"]]
            arrays = [pa.array(found[name], kind) for name, kind in types.items()]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n, _ in others), *arrays], names=names)

    return map_batches(df, run, schema)


def encode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` and ``token_ids``: the ids of the whole ``text``, as little-endian 32-bit numbers.

    NULL counts as the empty text, which has no ids. Strings of added tokens in a text become
    those tokens. A column of the same name is replaced.
    """
    return _with_columns(df, path, text, {"token_ids": "binary"})


def lengths(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` and ``n_tokens``: how many ids the whole ``text`` has."""
    return _with_columns(df, path, text, {"n_tokens": "bigint"})


def decode(df: DataFrame, path: str) -> DataFrame:
    """``df`` with ``token_ids``, and ``decoded``: the labels of the ids, joined. NULL gives the empty text."""
    return _with_columns(df, path, "token_ids", {"decoded": "string"})


def round_trip(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``encode``, then ``decode`` of those ids, in one pass: one Python worker a task instead of two."""
    return _with_columns(df, path, text, {"token_ids": "binary", "decoded": "string"})


def token_count(token_ids: str = "token_ids"):
    return (F.octet_length(token_ids) / 4).cast("long")
