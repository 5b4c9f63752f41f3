"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust a score.

Built-in column expressions only. The patterns are written so that the matcher neither recurses
nor rescans: repetitions are possessive where what follows cannot match inside them, and a match
begins where a run of its letters begins, or where the last match ended (``\\G``). They find the
same spans as the plain forms. A pattern runs only on texts that hold a character it needs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from recfold.llm.rows import own_columns

CONTEXT = 40
THRESHOLD = 0.5
_IN_EMAIL = "A-Za-z0-9._%+-"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    """``needs``: characters without one of which there is no match. ``base``: kept whatever the score."""

    name: str
    needs: str
    pattern: str
    score: float
    context: str
    base: bool = True


KINDS = (
    Kind("email", "[@]", rf"(?:\G|(?<![{_IN_EMAIL}]))[{_IN_EMAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9,
         "e-?mail|mail|contact|contacto|courriel|kontakt"),
    Kind("ip", "[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6,
         "ip|address|server|host|client|login|adresse"),
    Kind("card", "[0-9]", r"[0-9](?:[\x20-]?+[0-9])++", 0.8,
         "card|credit|visa|mastercard|amex|debit|karte|carte|tarjeta"),
    Kind("phone", "[+]", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7,
         "phone|call|tel|mobile|fax|telefon|telefono|telephone|whatsapp"),
    Kind("iban", "[0-9]", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]){11,30}+(?![A-Za-z0-9])", 0.8,
         "iban|account|bank|konto|compte|cuenta", False),
    Kind("national_id", "[0-9]", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", 0.35,
         "ssn|social security|social|tax id|national id|dni", False),
    Kind("local_phone", "[0-9]", r"(?<![0-9+(-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])", 0.35,
         "phone|call|tel|mobile|fax|telefon|telefono|telephone|whatsapp", False),
)


def _mod_97(iban: Column) -> Column:
    """Remainder of the number that an account spells, its first four letters last and letters as 10 to 35."""
    plain = F.regexp_replace(iban, " ", "")
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def step(rest: Column, letter: Column) -> Column:
        code = F.ascii(letter)
        return (
            F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97).cast("int")
        )

    return F.aggregate(F.split(moved, ""), F.lit(0), lambda rest, c: F.when(c == "", rest).otherwise(step(rest, c)))


def _confirmed(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return found.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        return _mod_97(found) == 1
    if kind == "national_id":
        return ~found.rlike("^(?:000|666|9)") & ~found.rlike("-00-|-0000$")
    return F.lit(True)


def _following(hits: Column, gaps: Column) -> Column:
    """For each match the ``CONTEXT`` letters behind it, later matches included; put together from the end."""
    def step(state: Column, pair: Column) -> Column:
        after = F.left(F.concat(F.left(pair["gap"], F.lit(CONTEXT)), state["next"]), F.lit(CONTEXT))
        onward = F.left(F.concat(F.left(pair["hit"], F.lit(CONTEXT)), after), F.lit(CONTEXT))
        return F.struct(onward.alias("next"), F.concat(F.array(after), state["out"]).alias("out"))

    pairs = F.arrays_zip(hits.alias("hit"), F.slice(gaps, F.lit(2), F.size(hits)).alias("gap"))
    none = F.struct(F.lit("").alias("next"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(F.reverse(pairs), none, step, lambda state: state["out"])


def _spans(kind: Kind, rank: int, text: Column) -> Column:
    """All matches of a kind with places in code points: gaps and matches alternate, so lengths add up."""
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), 0)
    gaps = F.split(text, kind.pattern, -1)
    none = F.struct(F.lit(0).alias("end"), F.lit("").alias("last"), F.array().cast(_SPANS).alias("out"))
    words = rf"(?:^|[^a-z])(?:{kind.context})(?:[^a-z]|$)"

    def step(state: Column, pair: Column) -> Column:
        start = state["end"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        before = F.right(F.concat(state["last"], F.right(pair["gap"], F.lit(CONTEXT))), F.lit(CONTEXT))
        near = F.lower(before).rlike(words) | F.lower(pair["after"]).rlike(words)
        score = F.least(F.lit(kind.score) + F.when(near, F.lit(0.3)).otherwise(F.lit(0.0)), F.lit(1.0))
        span = F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind.name).alias("kind"),
            score.alias("score"), pair["hit"].alias("found"),
        )
        last = F.right(F.concat(before, F.right(pair["hit"], F.lit(CONTEXT))), F.lit(CONTEXT))
        return F.struct(end.alias("end"), last.alias("last"), F.concat(state["out"], F.array(span)).alias("out"))

    pairs = F.arrays_zip(
        hits.alias("hit"), F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"), _following(hits, gaps).alias("after")
    )
    found = F.aggregate(pairs, none, step, lambda state: state["out"])
    found = F.filter(found, lambda span: _confirmed(kind.name, span["found"]))
    if not kind.base:
        found = F.filter(found, lambda span: span["score"] >= THRESHOLD)
    return F.when(text.rlike(kind.needs), found).otherwise(F.array().cast(_SPANS))


_SPANS = "array<struct<start:int,rank:int,end:int,kind:string,score:double,found:string>>"


def find_spans(docs: DataFrame) -> DataFrame:
    """``docs`` and ``pii_base``, ``pii_spans``: arrays of (start, rank, end, kind, score, found), by start.

    ``pii_base`` has all e-mail and IP addresses, cards and phones. ``pii_spans`` has these and
    what the method adds where it overlaps none of them: accounts that pass mod 97, and national
    ids and local phones with a context word among the 40 letters before or behind them. Places count code points, the end is
    exclusive. NULL and empty texts have no spans; rows are judged one by one, repeated ones
    alike. Columns of these names are replaced.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    names = [f"__recfold_pii_{kind.name}" for kind in KINDS]
    kept = [c for c in docs.columns if c.lower() not in ("pii_base", "pii_spans")]
    found = docs.select(
        *(F.col(f"`{c}`") for c in kept),
        *(_spans(kind, rank, text).alias(name) for rank, (kind, name) in enumerate(zip(KINDS, names, strict=True))),
    )
    base = F.array_sort(F.concat(*(F.col(n) for n, kind in zip(names, KINDS, strict=True) if kind.base)))
    found = found.select(*(F.col(f"`{c}`") for c in kept), base.alias("pii_base"), *names[sum(k.base for k in KINDS):])
    more = F.concat(*(F.col(n) for n, kind in zip(names, KINDS, strict=True) if not kind.base))
    apart = F.filter(more, lambda span: ~F.exists(
        F.col("pii_base"), lambda other: (other["start"] < span["end"]) & (span["start"] < other["end"])
    ))
    spans = F.when(F.size(more) == 0, F.col("pii_base")).otherwise(F.array_sort(F.concat("pii_base", apart)))
    return found.select(*(F.col(f"`{c}`") for c in kept), "pii_base", spans.alias("pii_spans"))


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("long")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in angle brackets; other columns stay.

    Overlapping spans become one replacement, named for the one that begins first. NULL stays NULL.
    """
    found = find_spans(docs.select(*own_columns(docs)))
    text = F.col("text").cast("string")
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        inside = span["start"] < state["at"]
        out = F.concat(state["out"], gap, F.lit("<"), F.upper(span["kind"]), F.lit(">"))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"), F.when(inside, state["out"]).otherwise(out).alias("out")
        )

    joined = F.aggregate(
        "pii_spans", begin, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    )
    clean = F.when(F.size("pii_spans") == 0, text).otherwise(joined)
    return found.select(*(clean.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns))
