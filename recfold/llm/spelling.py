"""Grouping of spelling variants: pairs of words one edit apart, found by pivotal grams.

The bigrams of a word, each with its place, are ordered by how rare they are among all words. One
edit changes two bigrams at most, so the three first of that order (the prefix, with all places of
the last bigram in it) hold two that do not overlap: the pivots, chosen by dynamic programming so
that they are as rare as can be. An edit leaves one pivot whole. Of two words one edit apart, take
the one whose prefix ends earlier in the order: a pivot of it that was left whole stands in the
other word's prefix.

Its place there is limited. Either the edit is before the second pivot and all from that pivot on
is the same, or it is behind the first pivot and all up to its end is the same; and of what is left
to search the edit spares one half. So pivots look up prefixes by length, place, the text on the
spared side and the spared half; what they fetch is verified by edit distance.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recfold.llm.rows import map_batches, slices, stored

RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DAMAGED = 97
_PRIME = (1 << 61) - 1
_BASE = 1_000_003
_MASK = (1 << 64) - 1
_PREFIX = 3
_PIVOTS = 2
_BATCH = 1 << 14

Gram = tuple[int, int]  # rank among all bigrams, rarest first, and place in the word


def words(docs: DataFrame) -> DataFrame:
    """``(word, n)``: the distinct words of all texts after the contract's damage, with their number.

    A word is a longest run of Latin letters, A to Z lower-cased; of one in 97, by a fixed rule of
    document and run, a letter is deleted. Words of under five letters or three occurrences are
    left out. NULL texts have none; a NULL ``doc_id`` stands as an empty text in the rule.
    """
    run = F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run)
    runs = runs.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    drawn = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    runs = runs.select("run", F.length("run").alias("size"), drawn.alias("h"))
    gone = (F.col("h") % F.col("size")).cast("int")
    left = F.concat(F.col("run").substr(F.lit(1), gone), F.col("run").substr(gone + 2, F.col("size")))
    damaged = F.col("h") % _DAMAGED == 0
    runs = runs.filter(F.col("size") >= F.when(damaged, LEAST_LENGTH + 1).otherwise(LEAST_LENGTH))
    found = runs.select(F.when(damaged, left).otherwise(F.col("run")).alias("word"))
    return found.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def bigram_ranks(vocabulary: DataFrame) -> dict[str, int]:
    """Each bigram of the words with its place in the order, rarest first.

    The alphabet has 90 letters, so there are 8,100 bigrams at most, whatever the words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for word in batch.column("word").to_pylist():
                seen.update(map("".join, zip(word, word[1:], strict=False)))
        yield pa.RecordBatch.from_pydict({"gram": list(seen), "n": pa.array(seen.values(), pa.int64())})

    counts = map_batches(vocabulary.select("word"), count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {row.gram: rank for rank, row in enumerate(sorted(counts.collect(), key=lambda row: (row.n, row.gram)))}


def prefix_of(word: str, ranks: dict[str, int]) -> list[Gram]:
    """The three rarest bigrams and every further place of the last of them."""
    grams = sorted((ranks[word[at: at + 2]], at) for at in range(len(word) - 1))
    last = grams[min(_PREFIX, len(grams)) - 1][0]
    return [gram for gram in grams if gram[0] <= last]


def pivots_of(prefix: list[Gram]) -> list[Gram]:
    """Two bigrams of the prefix that share no letter, of least sum of ranks.

    A row of the table has the cheapest choice of so many pivots among the first bigrams by place:
    the last of these is left out, or it joins a choice among those that end before it begins.
    """
    grams = sorted(prefix, key=lambda gram: gram[1])
    row: list[tuple[float, tuple[Gram, ...]]] = [(0, ())] * (len(grams) + 1)
    for _ in range(_PIVOTS):
        fewer, row = row, [(math.inf, ())]
        apart = 0
        for number, (rank, at) in enumerate(grams):
            while apart < number and grams[apart][1] <= at - 2:
                apart += 1
            cost, chosen = fewer[apart]
            row.append(min(row[-1], (cost + rank, (*chosen, (rank, at)))))
    return list(row[-1][1])


def _key(kind: int, length: int, place: int, one: int, other: int) -> int:
    """A signed 64-bit number for a kind, a word's length, a bigram's place and the hashes of two texts."""
    value = (one * 0x9E3779B97F4A7C15 + other * 0xC2B2AE3D27D4EB4F) & _MASK
    value ^= value >> 29
    value = (value * 0xBF58476D1CE4E5B9 + (length * 4 + kind) * 0x94D049BB133111EB + place * 0xD6E8FEB86659FD93) & _MASK
    value ^= value >> 32
    return value - (1 << 64) if value >> 63 else value


def _behind(length: int, place: int) -> int:
    """Where the second half of the text behind a bigram begins."""
    return place + 2 + (length - place - 2) // 2


def keys_of(word: str, ranks: dict[str, int]) -> tuple[list[int], list[int], int]:
    """Keys by which a word looks others up, keys by which it is found, and the rank its prefix ends with.

    Kinds 0 and 1: the edit is behind the bigram, in the second half of the text there or in the
    first; 2 and 3: it is before the bigram, in the second half or in the first. Lengths, places
    and halves are those of the word that is looked for: one letter shorter, as long, or one longer.
    """
    size = len(word)
    upto, since = [0] * (size + 1), [0] * (size + 1)
    for at, letter in enumerate(word):
        upto[at + 1] = (upto[at] * _BASE + ord(letter)) % _PRIME
    for at in range(size - 1, -1, -1):
        since[at] = (since[at + 1] * _BASE + ord(word[at])) % _PRIME
    prefix = prefix_of(word, ranks)
    (_, first), (_, second) = pivots_of(prefix)
    asks = []
    for change in (-1, 0, 1):
        length, half = size + change, _behind(size + change, first)
        if half <= size:
            asks.append(_key(0, length, first, upto[half], 0))
        asks.append(_key(1, length, first, upto[first + 2], since[half - change]))
        place = second + change
        half = place // 2
        asks.append(_key(2, length, place, upto[half], since[second]))
        asks.append(_key(3, length, place, since[half - change], 0))
    offers = []
    for _, at in prefix:
        half = _behind(size, at)
        offers += _key(0, size, at, upto[half], 0), _key(1, size, at, upto[at + 2], since[half])
        half = at // 2
        offers += _key(2, size, at, upto[half], since[at]), _key(3, size, at, since[half], 0)
    return asks, offers, prefix[-1][0]


def letters_of(word: str) -> int:
    """Which letters a word has, folded to 32 bits: one edit changes two of them at most."""
    return sum(1 << code for code in {ord(letter) % 32 for letter in word})


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """``(a, b)``: ids of words one edit apart, ``a < b``; ``vocabulary`` has ``id``, ``word`` of five letters at least."""
    ranks = bigram_ranks(vocabulary)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word"):
            ids, keys, signs, asked = [], [], [], []  # a sign is the rank, then the letters

            def take() -> pa.RecordBatch:
                done = pa.RecordBatch.from_pydict({
                    "id": pa.array(ids, pa.int64()), "key": pa.array(keys, pa.int64()),
                    "sign": pa.array(signs, pa.int64()), "asks": pa.array(asked, pa.bool_()),
                })
                for column in (ids, keys, signs, asked):
                    column.clear()
                return done

            for number, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist(), strict=True):
                asks, offers, end = keys_of(word, ranks)
                sign = end << 32 | letters_of(word)
                for some, is_ask in ((asks, True), (offers, False)):
                    keys += some
                    ids += [number] * len(some)
                    signs += [sign] * len(some)
                    asked += [is_ask] * len(some)
                if len(ids) >= _BATCH:
                    yield take()
            yield take()

    entries = stored(map_batches(vocabulary.select("id", "word"), index, "id long, key long, sign long, asks boolean"),
                     "grams")
    asks = entries.filter("asks").select("key", F.col("id").alias("x"), F.col("sign").alias("x_sign"))
    offers = entries.filter("not asks").select("key", F.col("id").alias("y"), F.col("sign").alias("y_sign"))
    others = F.bit_count(F.col("x_sign").bitwiseXOR(F.col("y_sign")).bitwiseAND(0xFFFFFFFF))
    earlier = F.shiftright("x_sign", 32) <= F.shiftright("y_sign", 32)
    met = asks.join(offers, "key").filter(earlier & (others <= 2) & (F.col("x") != F.col("y")))
    pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    left = vocabulary.select(F.col("id").alias("a"), F.col("word").alias("a_word"))
    right = vocabulary.select(F.col("id").alias("b"), F.col("word").alias("b_word"))
    held = pairs.join(left, "a").join(right, "b")
    return held.filter(F.levenshtein("a_word", "b_word", 1) == 1).select("a", "b")


def _roots(forms: DataFrame) -> DataFrame:
    """``(id, root)`` for ``(id, form)``: the last of the forms that follow each other.

    Each round doubles the steps; a form is at least twice as frequent, so 40 steps, which is six
    rounds, would need words that occur a million million times.
    """
    at = stored(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("id").alias("root"), F.col("root").alias("next"))
        moved = at.join(further, "root", "left")
        after = stored(moved.select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                       "roots")
        at = after.select("id", "root")
        if not after.filter("moved").limit(1).count():
            return at


def group(vocabulary: DataFrame) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each row of ``vocabulary`` (``word``, ``n``; words distinct).

    Near words are one inserted, deleted or replaced code point away. A word's form is the most
    frequent of them (the smaller one of equals) if it is twice as frequent or more, else NULL; its
    root is where forms lead in the end, the word itself without one. Words have five of the 90
    letters at least, as `words` returns them. An empty table gives no rows; other columns are
    left out.
    """
    known = stored(vocabulary.select("word", "n", F.monotonically_increasing_id().alias("id")), "vocabulary")
    pairs = stored(near_pairs(known), "near")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = known.select(F.col("id").alias("b"), F.col("n").alias("b_n"), F.col("word").alias("b_word"))
    most = F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b_word").alias("form"), F.col("b").alias("form_id")))
    near = both.join(other, "b").groupBy(F.col("a").alias("id")).agg(F.count("*").alias("n_near"), most.alias("most"))
    joined = known.join(near, "id", "left")
    twice = -F.col("most.less") >= 2 * F.col("n")
    found = stored(joined.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        *(F.when(twice, F.col(f"most.{name}")).alias(name) for name in ("form", "form_id")),
        F.when(twice, -F.col("most.less")).alias("form_n"),
    ), "forms")
    roots = _roots(found.filter("form_id is not null").select("id", F.col("form_id").alias("form")))
    names = known.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    found = found.join(roots.join(names, "root").select("id", "root_word"), "id", "left")
    return found.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
