"""Repair of conversation structure at least cost, by an auction algorithm for shortest paths.

A conversation is a lattice: a layer of nodes before each row and one after the last, a node for
each thing the repaired text may end with so far (nothing, system, user, assistant). Edits are its
arcs, with whole-number costs. An auction runs from the nodes of the last layer to those of the
first, all with one destination: a path is extended along an arc that the node prices make tight,
or contracted after its end node's price was raised. A path that meets a node served before has
found its way. The prices it ends with are exact distances, so the tight arcs are those of cheapest
edits, and reading them with the least letter first gives the least audit.

Layers that have the same row and the same prices (up to a constant) behind them converge to the
same prices, so their auctions are remembered.

A conversation may hold any share of all rows. Rows are sorted over the whole table and cut into
blocks; a conversation inside a block is repaired there and then. Of the others, each block yields
its cost from any entry to any exit; passes over those small tables, back and forth, give every
block the prices behind it and the node it is entered by, and the blocks are repaired side by side.
Only the digest of a repaired text, which its definition makes sequential, reads the blocks of a
conversation one after the other, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from recfold.llm.rows import map_batches, slices, stored

BLOCK_ROWS = 4096  # of a conversation that are repaired at once
BLOCK_BYTES = 4 << 20  # of their texts
_PREFIX = 64
_WHITE = " \t\n\x0b\x0c\r"
_LONG = (1 << 63) - 1
_OUT_ROWS = 512
_OUT_BYTES = 4 << 20

# What the repaired conversation ends with so far.
START, SYSTEM, USER, ASSISTANT = range(4)
_FAR = 1 << 40
_ROLES = {USER: "user", ASSISTANT: "assistant"}
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_LEGAL = {"su", "ua", "au"}
FORCED = "x"
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1

Prices = tuple[int, int, int, int]
Arc = tuple[str, int, bool, int]  # letter, cost, leads to the next layer, node


@lru_cache(maxsize=None)
def arcs(token: str, state: int) -> tuple[Arc, ...]:
    """Arcs out of a node, in the order of their letters.

    A token is the first letter of a row's role (``o`` for others), a capital where the row is
    truncated, or ``x`` for rows that must be deleted, whose cost is a constant counted elsewhere.
    """
    insert = ("I", INSERT, False, _NEXT[state])
    if token == FORCED:
        return ("D", 0, True, state), insert
    extra = TRUNCATED * token.isupper()
    found = [("D", DELETE, True, state), insert]
    kept = {"s": SYSTEM if state == START else None, "u": USER, "a": ASSISTANT}.get(token.lower())
    if kept is not None and kept in (SYSTEM, _NEXT[state]):
        found.append(("K", extra, True, kept))
    found.append(("R", REROLE + extra, True, _NEXT[state]))
    return tuple(found)


@lru_cache(maxsize=1 << 16)
def auction(token: str, behind: Prices) -> Prices:
    """Prices of a layer's nodes, given the settled prices of the layer behind it.

    Every node in turn is the origin of a path. Prices only rise and never exceed what an arc
    costs with the price behind it, so a path over tight arcs is a cheapest one.
    """
    prices = [0, 0, 0, 0]
    settled: set[int] = set()
    for origin in range(4):
        path = [origin]
        while path[-1] not in settled:
            node = path[-1]
            cost, ahead, after = min(
                (cost + (behind[to] if ahead else prices[to]), not ahead, to)
                for _, cost, ahead, to in arcs(token, node)
            )
            if prices[node] < cost:  # raise the price and step back
                prices[node] = cost
                if len(path) > 1:
                    path.pop()
            elif ahead:  # a node of the same layer
                path.append(after)
            else:
                break
        settled.update(path)
    return tuple(prices)


# At the end only nothing at all or an answered user may be left; the rest is inserted.
END: Prices = (0, 2 * INSERT, INSERT, 0)


def converge(tokens: str, behind: Prices) -> list[Prices]:
    """Prices of every layer, the one behind the last row last."""
    prices = [behind]
    for token in reversed(tokens):
        after = prices[-1]
        low = min(after)
        prices.append(tuple(low + p for p in auction(token, tuple(p - low for p in after))))
    return prices[::-1]


def trace(tokens: str, prices: list[Prices], state: int) -> tuple[list[tuple[str, int]], int]:
    """The tight arcs from a node of the first layer, least letter first: letters with what they lead to."""
    steps = []
    layer = 0
    while layer < len(tokens):
        for letter, cost, ahead, to in arcs(tokens[layer], state):
            if prices[layer][state] == cost + prices[layer + ahead][to]:
                steps.append((letter, to))
                state = to
                layer += ahead
                break
    return steps, state


def ending(state: int) -> list[tuple[str, int]]:
    """The insertions behind the last row."""
    return {SYSTEM: [("I", USER), ("I", ASSISTANT)], USER: [("I", ASSISTANT)]}.get(state, [])


def costs(tokens: str) -> list[int]:
    """The least cost from each entry to each exit of a block, 16 numbers; far where there is no way."""
    table = [[_FAR] * 4 for _ in range(4)]
    if not tokens:
        for state in range(4):
            table[state][state] = 0
    else:
        rows = tokens.replace(FORCED, "")
        all_gone = DELETE * len(rows)
        table[START][START] = table[SYSTEM][SYSTEM] = all_gone
        kept = [TRUNCATED * row.isupper() for row in rows if row in "sS"]
        if kept:
            table[START][SYSTEM] = all_gone - DELETE + min(kept)
        for target in (USER, ASSISTANT):
            behind = [_FAR] * 4
            behind[target] = 0
            for state, price in enumerate(converge(tokens, tuple(behind))[0]):
                table[state][target] = price
    return [cost for row in table for cost in row]


def damage(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, n)`` after the damage of the contract; ``n`` says how often a row stands there.

    A fixed rule of the id and the turn drops a row (``n`` is 0 then), empties it, takes its
    sentence ends, repeats it or makes it the user's. NULL texts and roles, and NULL ids and turns
    within the rule, count as one space. Other columns are left out.
    """
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    space = F.lit(" ")
    key = F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))
    rows = conversations.select(
        conv.alias("conv_id"), turn.alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).cast("int").alias("kind"),
    )
    kind = F.col("kind")
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def _distinct_rows(rows: DataFrame) -> DataFrame:
    """Rows once each with their number, and whether a row is the first of its role and text in its conversation.

    Both are sums over partly added rows: neither a row that is repeated a million times nor a
    text that stands in every turn comes together in one task. Role and text meet by SHA-256.
    """
    role_text = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    there = F.col("n") > 0
    rows = rows.select(
        "conv_id", "n",
        *(F.when(there, F.col(name)).alias(name) for name in ("turn", "role", "text")),
        F.when(there, F.unhex(F.sha2(role_text.cast("binary"), 256))).alias("digest"),
    )
    firsts = rows.filter(there).groupBy("conv_id", "digest").agg(
        F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("unplaced")
    )
    marks = firsts.select(
        "conv_id", F.when(~F.col("unplaced"), F.col("least")).alias("turn"), "digest",
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
        F.lit(0).cast("long").alias("n"), F.lit(True).alias("first"),
    )
    rows = rows.select("conv_id", "turn", "digest", "role", "text", "n", F.lit(False).alias("first"))
    return rows.unionByName(marks).groupBy("conv_id", "turn", "digest").agg(
        F.max("role").alias("role"), F.max("text").alias("text"), F.sum("n").alias("n"), F.max("first").alias("first")
    )


@dataclass
class Block:
    """Rows of one conversation that follow each other."""

    conv: int | None
    tokens: list[str] = field(default_factory=list)
    counts: list[int] = field(default_factory=list)  # of the rows behind each token
    lines: list[str] = field(default_factory=list)  # role and text behind each token that may stay
    sizes: list[int] = field(default_factory=list)  # length of each line's role
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    forced: int = 0
    initial: str | None = None
    last: str | None = None
    low: int | None = None
    high: int | None = None
    turns: int = 0
    rows: int = 0
    held: int = 0

    def add(self, turn: int | None, role: str, text: str, n: int, first: bool) -> None:
        self.rows += 1
        if not n:
            return
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        start = role[:1]
        self.illegal += (self.last is not None and self.last + start not in _LEGAL) + (n - 1)
        self.initial = start if self.initial is None else self.initial
        self.last = start
        body = text.rstrip(_WHITE)
        spare = n
        if not body:
            self.blank += n
        elif not first:
            self.duplicate += n
        else:
            spare = n - 1
            self.duplicate += spare
            cut = body[-1] not in ".!?"
            self.truncated += cut
            token = start if start in ("s", "u", "a") else "o"
            self.tokens.append(token.upper() if cut else token)
            self.counts.append(1)
            self.lines.append(f"{role}:{text}")
            self.sizes.append(len(role))
            self.held += len(role) + len(text)
        if spare:
            self.forced += spare
            if self.tokens and self.tokens[-1] == FORCED:
                self.counts[-1] += spare
            else:
                self.tokens.append(FORCED)
                self.counts.append(spare)

    def full(self, most: int) -> bool:
        return self.rows >= most or self.held >= BLOCK_BYTES


def render(tokens: str, counts: list[int], lines: list[str], sizes: list[int],
           steps: list[tuple[str, int]]) -> tuple[str, list[str]]:
    """The audit and the repaired lines of these steps."""
    audit, out = [], []
    place = line = 0
    for letter, to in steps:
        if letter == "I":
            audit.append("I")
            out.append(f"{_ROLES[to]}:")
            continue
        audit.append(letter * counts[place])
        if tokens[place] != FORCED:
            if letter == "K":
                out.append(lines[line])
            elif letter == "R":
                out.append(_ROLES[to] + lines[line][sizes[line]:])
            line += 1
        place += 1
    return "".join(audit), out


_SUMS = ("blank", "duplicate", "truncated", "illegal", "forced")
_ENDS = ("initial", "last", "low", "high", "turns")
_RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string, repaired array<string>")
_BLOCK = ("part int, number int, tokens string, counts array<long>, lines array<string>, sizes array<int>, "
          "costs array<long>, initial string, last string, low long, high long, turns long, forced long")
_SCHEMA = f"{_RESULT}, {_BLOCK}"


class _Rows:
    """Output rows of a schema, yielded some at a time."""

    def __init__(self, schema: str) -> None:
        kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<string>": pa.list_(pa.string()),
                 "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
        parts = (part.strip().split(" ") for part in schema.split(","))
        self.schema = pa.schema([(name, kinds[kind]) for name, kind in parts])
        self.rows: list[dict] = []
        self.bytes = 0

    def add(self, row: dict, size: int = 0) -> None:
        self.rows.append(row)
        self.bytes += size

    def take(self, rest: bool = False) -> Iterator[pa.RecordBatch]:
        if self.rows and (rest or len(self.rows) >= _OUT_ROWS or self.bytes >= _OUT_BYTES):
            yield pa.RecordBatch.from_pylist(self.rows, schema=self.schema)
            self.rows, self.bytes = [], 0


def _gaps(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None else min(high - low + 1 - turns, _LONG)


def _whole(block: Block, with_lines: bool) -> dict:
    """The result of a conversation that lies in one block."""
    tokens = "".join(block.tokens)
    prices = converge(tokens, END)
    steps, state = trace(tokens, prices, START)
    audit, lines = render(tokens, block.counts, block.lines, block.sizes, steps + ending(state))
    return {
        "conv_id": block.conv, "gaps": _gaps(block.low, block.high, block.turns),
        "blank": block.blank, "duplicate": block.duplicate, "truncated": block.truncated, "illegal": block.illegal,
        "cost": prices[0][START] + DELETE * block.forced, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        "repaired": lines if with_lines else None,
    }


def _part_of(block: Block, part: int, number: int) -> dict:
    """A block of a conversation that may go on beyond it."""
    tokens = "".join(block.tokens)
    return {
        "conv_id": block.conv, "part": part, "number": number, "tokens": tokens, "counts": block.counts,
        "lines": block.lines, "sizes": block.sizes, "costs": costs(tokens),
        **{name: getattr(block, name) for name in (*_SUMS, *_ENDS)},
    }


def _solve(batches: Iterator[pa.RecordBatch], with_lines: bool, block_rows: int) -> Iterator[pa.RecordBatch]:
    """Results of the conversations that lie inside a block, and the blocks of the others.

    Rows come sorted. The first and the last conversation of a task may go on in other tasks.
    """
    out = _Rows(_SCHEMA)
    block: Block | None = None
    part = number = 0
    inside = False  # whether the conversation began in this task and is in this block as a whole so far

    def close(ended: bool) -> None:
        nonlocal number
        if ended and inside:
            out.add(_whole(block, with_lines), block.held)
        else:
            out.add(_part_of(block, part, number), block.held)
            number += 1

    for batch in slices(batches, "text"):
        columns = (batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "n", "first", "part"))
        for conv, turn, role, text, n, first, part in zip(*columns, strict=True):
            if block is None:
                block = Block(conv)
            elif conv != block.conv:
                close(True)
                block, inside = Block(conv), True
            elif block.full(block_rows):
                close(False)
                block, inside = Block(conv), False
            block.add(turn, role, text, n, first)
            yield from out.take()
    if block is not None:
        close(False)
    yield from out.take(True)


def _back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The prices behind each block; blocks of a conversation come last first."""
    out = _Rows("part int, number int, behind array<long>")
    conv, prices = object(), END
    for batch in batches:
        for row in batch.to_pylist():
            if row["conv_id"] != conv:
                conv, prices = row["conv_id"], END
            out.add({"part": row["part"], "number": row["number"], "behind": list(prices)})
            table = row["costs"]
            prices = tuple(min(table[4 * s + t] + prices[t] for t in range(4)) for s in range(4))
            yield from out.take()
    yield from out.take(True)


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where the cheapest edits of a block lead from each node it may be entered by."""
    out = _Rows("conv_id long, part int, number int, behind array<long>, exits array<int>")
    for batch in batches:
        for row in batch.to_pylist():
            prices = converge(row["tokens"], tuple(row["behind"]))
            exits = [trace(row["tokens"], prices, state)[1] for state in range(4)]
            kept = {name: row[name] for name in ("conv_id", "part", "number", "behind")}
            out.add(kept | {"exits": exits})
            yield from out.take()
    yield from out.take(True)


def _forth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The node by which each block is entered, and whether it is a conversation's last.

    Blocks of a conversation come first to last.
    """
    out = _Rows("part int, number int, behind array<long>, entry int, final int")
    held, state = None, START

    def put(final: bool) -> None:
        if held is not None:
            out.add({**{n: held[n] for n in ("part", "number", "behind")}, "entry": held["entry"], "final": int(final)})

    for batch in batches:
        for row in batch.to_pylist():
            new = held is None or row["conv_id"] != held["conv_id"]
            put(new)
            state = START if new else state
            held = row | {"entry": state}
            state = row["exits"][state]
            yield from out.take()
    put(True)
    yield from out.take(True)


_PIECE = ("conv_id long, part int, number int, audit string, repaired array<string>, blank long, duplicate long, "
          "truncated long, illegal long, cost long, initial string, last string, low long, high long, turns long")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The audit and the repaired lines of each block."""
    out = _Rows(_PIECE)
    for batch in batches:
        for row in batch.to_pylist():
            tokens = row["tokens"]
            prices = converge(tokens, tuple(row["behind"]))
            steps, state = trace(tokens, prices, row["entry"])
            price = prices[0][row["entry"]] - prices[-1][state]
            if row["final"]:
                steps = steps + ending(state)
                price += END[state]
            audit, lines = render(tokens, row["counts"], row["lines"], row["sizes"], steps)
            kept = ("conv_id", "part", "number", "blank", "duplicate", "truncated", "illegal", *_ENDS)
            out.add({name: row[name] for name in kept}
                    | {"audit": audit, "repaired": lines, "cost": price + DELETE * row["forced"]},
                    sum(map(len, lines)))
            yield from out.take()
    yield from out.take(True)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The results of conversations from their pieces, first to last; texts pass through the digest one by one."""
    out = _Rows(_RESULT)
    conv: object = object()
    sums: dict = {}

    def put() -> None:
        if sums:
            row = {n: sums[n] for n in ("blank", "duplicate", "truncated", "illegal", "cost")}
            out.add(row | {
                "conv_id": conv, "gaps": _gaps(sums["low"], sums["high"], sums["turns"]),
                "audit": "".join(sums["audit"]), "repaired_sha256": sums["hash"].hexdigest(), "repaired": None,
            })

    for batch in batches:
        for row in batch.to_pylist():
            if not sums or row["conv_id"] != conv:
                put()
                conv = row["conv_id"]
                sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "turns"), 0)
                sums |= {"last": None, "low": None, "high": None, "audit": [], "hash": hashlib.sha256(), "any": False}
            for name in ("blank", "duplicate", "truncated", "illegal", "cost", "turns"):
                sums[name] += row[name]
            if row["initial"] is not None:
                sums["illegal"] += sums["last"] is not None and sums["last"] + row["initial"] not in _LEGAL
                sums["last"] = row["last"]
            if row["low"] is not None:
                sums["turns"] -= row["low"] == sums["high"]
                sums["low"] = row["low"] if sums["low"] is None else sums["low"]
                sums["high"] = row["high"]
            sums["audit"].append(row["audit"])
            for line in row["repaired"]:
                sums["hash"].update((("\n" if sums["any"] else "") + line).encode())
                sums["any"] = True
            yield from out.take()
    put()
    yield from out.take(True)


def _in_order(df: DataFrame, *order: str | Column) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def _solved(rows: DataFrame, with_lines: bool, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Results of the conversations inside a block, and pieces of the others."""
    by = ("conv_id", "turn", "role", "text")
    ranged = _distinct_rows(rows).repartitionByRange(*by[:3], F.substring("text", 1, _PREFIX))
    ranged = ranged.sortWithinPartitions(*by).select(*by, "n", "first", F.spark_partition_id().alias("part"))
    found = stored(map_batches(ranged, lambda batches: _solve(batches, with_lines, block_rows), _SCHEMA), "conversations")
    blocks = found.filter("part is not null")
    at = ["part", "number"]
    last_first = _in_order(blocks.select("conv_id", *at, "costs"), F.desc("part"), F.desc("number"))
    behind = map_batches(last_first, _back, "part int, number int, behind array<long>")
    priced = blocks.select("conv_id", *at, "tokens").join(behind, at)
    exits = map_batches(priced, _exits, "conv_id long, part int, number int, behind array<long>, exits array<int>")
    entries = map_batches(_in_order(exits, *at), _forth,
                          "part int, number int, behind array<long>, entry int, final int")
    pieces = map_batches(blocks.drop("cost", "audit", "repaired").join(entries, at), _pieces, _PIECE)
    return found.filter("part is null").select(*(n.split(" ")[0] for n in _RESULT.split(", "))), pieces


def audit(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for each ``conv_id`` of ``rows`` (``conv_id, turn, role, text, n``): faults, cost, audit, digest.

    Rows of a conversation stand in the order of turn (NULL first), role and text, ``n`` times
    each; rows with ``n`` of 0 only say that the conversation exists. A row without anything but
    blanks, with a role and text that stood before, or without a sentence end has that first of
    these faults. NULL ``conv_id`` is one conversation. No rows: zeros, an empty audit and the
    digest of nothing; an empty table gives no rows. Roles and texts are taken as they are and are
    not NULL, as `damage` returns them; other columns are left out. ``illegal`` counts all rows.
    The size of a block has no influence on the result.
    """
    whole, pieces = _solved(rows, False, block_rows)
    result = whole.unionByName(map_batches(_in_order(pieces, "part", "number"), _joined, _RESULT))
    return result.drop("repaired")


def repaired(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The repaired conversations: ``(conv_id, part, number, place, line)``, a ``role:text`` for each line that is left.

    Lines of a conversation stand in the order of the three columns behind its id. Rows, NULLs,
    repeats and empty tables as in `audit`; a conversation of which nothing is left has no line.
    """
    whole, pieces = _solved(rows, True, block_rows)
    zero = F.lit(0)
    whole = whole.select("conv_id", zero.alias("part"), zero.alias("number"), "repaired")
    lines = whole.unionByName(pieces.select("conv_id", "part", "number", "repaired"))
    return lines.select("conv_id", "part", "number", F.posexplode("repaired").alias("place", "line"))
