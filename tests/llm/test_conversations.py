"""The repair of conversations against a dynamic programme over whole audits, on the given and on awkward tables."""

import hashlib
import random
import re
import zlib

import pytest

from recfold.llm import conversations, queries

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if value is None else value for value in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def brute(rows):
    """Least (cost, audit) for each thing the text may end with, row by row."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(WHITE)
        faults.append(
            "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    best = {"": (0, "", ())}

    def better(table, key, cost, audit, lines):
        if key not in table or (cost, audit) < table[key][:2]:
            table[key] = (cost, audit, lines)

    def following(key):
        return ("a", "assistant") if key == "u" else ("u", "user")

    def insert(table):
        for _ in range(4):
            for key, (cost, audit, lines) in list(table.items()):
                to, role = following(key)
                better(table, to, cost + 2, audit + "I", (*lines, f"{role}:"))

    for (_, role, text), fault in zip(rows, faults, strict=True):
        insert(best)
        table = {}
        for key, (cost, audit, lines) in best.items():
            better(table, key, cost + 3, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            cost += fault == "truncated"
            to, name = following(key)
            if role[:1] == to or (role[:1] == "s" and key == ""):
                better(table, role[:1], cost, audit + "K", (*lines, f"{role}:{text}"))
            better(table, to, cost + 2, audit + "R", (*lines, f"{name}:{text}"))
        best = table
    insert(best)
    cost, audit, lines = min((best[key] for key in ("", "a") if key in best), key=lambda found: found[:2])
    turns = [turn for turn, _, _ in rows if turn is not None]
    first = [role[:1] for _, role, _ in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{name: faults.count(name) for name in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False)),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }, lines


def expected(rows):
    by_conv = {}
    for row in rows:
        by_conv.setdefault(row[0], []).append(row)
    return {conv: brute(damaged(own)) for conv, own in by_conv.items()}


def awkward():
    """NULLs in every column, ties of turns, repeated rows, empty and colon roles, a conversation that is dropped whole."""
    draw = random.Random(5)
    roles = ["user", "assistant", "system", "tool", "", None, "user:x"]
    texts = ["a.", "b", " ", "", None, "long text.", "x!  ", "q" * 5000, "é?"]
    rows = [(conv, draw.choice([None, *range(200)]), draw.choice(roles), draw.choice(texts))
            for conv in (None, 1, 2) for _ in range(draw.randint(150, 400))]
    rows += [(conv, draw.choice([None, *range(9)]), draw.choice(["user", "assistant", "system"]), f"text {n % 7}.")
             for conv in range(10, 120) for n in range(draw.randint(1, 12))]
    rows += rows[:40]
    gone = next(n for n in range(1000, 2000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    return [*rows, (gone, 0, "user", "Hello.")], gone


@pytest.mark.parametrize("block", [3, 4096])
def test_awkward_conversations(spark, block):
    rows, gone = awkward()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    df = df.selectExpr("*", "'clash' AS n", "'clash' AS first", "'clash' AS part", "'clash' AS audit")
    want = expected(rows)
    got = {r.conv_id: r.asDict() for r in conversations.audit(conversations.damage(df), block).collect()}
    assert got == {conv: {"conv_id": conv, **result} for conv, (result, _) in want.items()}
    assert got[gone] == {"conv_id": gone, **dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0),
                         "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    lines = conversations.repaired(conversations.damage(df), block).collect()
    for conv, (_, want_lines) in want.items():
        mine = sorted((r.part, r.number, r.place, r.line) for r in lines if r.conv_id == conv)
        assert tuple(line for *_, line in mine) == want_lines


def test_given_conversations(spark, small):
    rows = [tuple(r) for r in queries.table(spark, small, "conversations").collect()]
    got = {r.conv_id: r.asDict() for r in queries.QUERIES["op11_conversation_auction"](spark, small).collect()}
    assert got == {conv: {"conv_id": conv, **result} for conv, (result, _) in expected(rows).items()}


def test_blocks_of_one_conversation_join_to_the_same_result():
    """A long conversation cut anywhere has the cost, audit and text of the whole one."""
    draw = random.Random(7)
    for _ in range(300):
        tokens = "".join(draw.choices("suaoSUAOx", k=draw.randint(0, 30)))
        whole = conversations.converge(tokens, conversations.END)
        steps, state = conversations.trace(tokens, whole, 0)
        cuts = sorted(draw.choices(range(len(tokens) + 1), k=3))
        parts = [tokens[a:b] for a, b in zip([0, *cuts], [*cuts, len(tokens)], strict=True)]
        behind = [conversations.END]
        for part in reversed(parts):
            table = conversations.costs(part)
            behind.append(tuple(min(table[4 * s + t] + behind[-1][t] for t in range(4)) for s in range(4)))
        assert behind[-1][0] == whole[0][0]
        node, joined = 0, []
        for part, after in zip(parts, behind[-2::-1], strict=True):
            some, node = conversations.trace(part, conversations.converge(part, after), node)
            joined += some
        assert (joined, node) == (steps, state)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.audit(conversations.damage(empty)).count() == 0
    assert conversations.repaired(conversations.damage(empty)).count() == 0


def test_equal_rows_and_texts_of_one_conversation_are_not_sent_one_by_one(spark):
    """Half a million equal rows reach the shuffle as a row for each task."""
    rows = spark.range(500_000).selectExpr("1L AS conv_id", "7L AS turn", "'user' AS role", "'Yes.' AS text", "1L AS n")
    [row] = conversations.audit(rows).collect()
    assert (row.duplicate, row.cost, row.illegal) == (499_999, 3 * 499_999 + 2, 499_999)
    assert row.audit == "K" + "D" * 499_999 + "I"
