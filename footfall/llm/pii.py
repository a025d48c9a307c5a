"""Personal data: patterns propose spans, checksums confirm, context adjusts a score.

Everything is column expressions on the row that holds the text.  A pattern's
matches and the pieces between them, both in order, give the positions.  Texts
without a kind's tell-tale character skip its pattern, and the patterns are
written so that no run of characters is read again from each of its places.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.line_rules import let

_LOCAL = "[A-Za-z0-9._%+-]"
_FROM_RUN = r"(?:\G|(?<!{0}))"  # where a run starts, or right after the last match
# Zeros alone, or a number of at most 255 after any zeros.
_BYTE = "(?:0++(?![0-9])|0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?))"
AGAINST = (
    r"\b(?:example|sample|test|dummy|placeholder|beispiel|muster|exemple|ejemplo|prueba)\b"
)
CONTEXT = 40  # code points on either side that are searched for context words


@dataclass(frozen=True)
class Kind:
    """A kind of span: its sign, pattern, test, and words that speak for or against it."""

    name: str
    sign: str
    pattern: str
    score: float
    context: str
    always: bool = False  # a base span, kept whatever its score


# The base kinds in their order, then the ones the method adds.
KINDS = (
    Kind(
        "email", "@",
        _FROM_RUN.format(_LOCAL) + _LOCAL + r"++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.9, r"\b(?:e-?mail|contact|write to|reach|kontakt|courriel|correo)\b", True,
    ),
    Kind(
        "ip", r"[0-9]\.[0-9]",
        _FROM_RUN.format("[0-9]") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        0.6, r"\b(?:ip|host|server|address|login|adresse|serveur|servidor)\b", True,
    ),
    Kind(
        "card", "[0-9]", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,}+",
        0.7, r"\b(?:card|visa|mastercard|amex|credit|payment|cvv|karte|kreditkarte|carte|tarjeta)\b", True,
    ),
    Kind(
        "phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]",
        0.7, r"\b(?:phone|call|tel|mobile|fax|whatsapp|telefon|handy|portable|m.vil)\b", True,
    ),
    Kind(
        "iban", "[A-Z]{2}[0-9]{2}",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
        0.8, r"\b(?:iban|bank|account|konto|compte|cuenta|banque|banco)\b",
    ),
    Kind(
        "ssn", "[0-9]-[0-9]", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        0.4, r"\b(?:ssn|social security|taxpayer)\b",
    ),
    Kind(
        "local_phone", "[0-9]-[0-9]", r"(?<![0-9+-])(?:\([0-9]{3}\)\x20?|[0-9]{3}-)[0-9]{3}-[0-9]{4}(?![0-9-])",
        0.4, r"\b(?:phone|call|tel|mobile|fax)\b",
    ),
)
BASE = tuple(kind.name for kind in KINDS if kind.always)
THRESHOLD = 0.6


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn checksum of a string of digits: every second from the right doubled."""

    def value(i: Column) -> Column:
        digit = F.substring(F.reverse(digits), i + 1, 1).cast("int")
        return F.when(i % 2 == 0, digit).otherwise(digit * 2 - F.when(digit > 4, 9).otherwise(0))

    each = F.transform(F.sequence(F.lit(0), F.length(digits) - 1), value)
    return F.aggregate(each, F.lit(0), lambda total, x: total + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """Checksum of an account number: moved, spelled as digits, 1 modulo 97."""
    flat = F.replace(iban, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(flat, 5, 64), F.substring(flat, 1, 4))
    values = F.transform(
        F.split(moved, ""),
        lambda c: F.when(c.rlike("[0-9]"), c.try_cast("int")).otherwise(F.ascii(c) - 55),
    )
    rest = F.aggregate(
        values,
        F.lit(0),
        lambda total, x: (total * F.when(x > 9, 100).otherwise(10) + F.coalesce(x, F.lit(0))) % 97,
    )
    return rest == 1


# Lengths of account numbers by country, where they are in use.
IBAN_LENGTHS = (
    "AT20 BE16 BG22 CH21 CY28 CZ24 DE22 DK18 EE20 ES24 FI18 FR27 GB22 GR27 HR21 HU28 IE22 IS26 "
    "IT27 LI21 LT20 LU20 LV21 MC27 MT31 NL18 NO15 PL28 PT25 RO24 SE24 SI19 SK24 SM27 TR26"
)


def _right_length(iban: Column) -> Column:
    """Whether an account number is as long as its country's; any length where none is known."""
    flat = F.replace(iban, F.lit(" "), F.lit(""))
    known = F.create_map(
        *(F.lit(v) for x in IBAN_LENGTHS.split() for v in (x[:2], int(x[2:])))
    )
    want = F.try_element_at(known, F.substring(flat, 1, 2))
    return F.coalesce(want == F.length(flat), F.lit(True))


def _confirmed(kind: str, found: Column) -> Column:
    """Whether a match passes its kind's validator."""
    if kind == "ip":
        return found.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return let(
            _digits(found),
            lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False)),
        )
    if kind == "phone":
        return F.length(_digits(found)).between(9, 15)
    if kind == "iban":
        return _right_length(found) & mod97(found)
    if kind == "ssn":
        return ~found.rlike(r"^(?:000|666|9..)|-00-|-0000$")
    return F.lit(True)


SPAN = "struct<start:int,rank:int,stop:int,kind:string,score:double,context:string>"
_NONE = f"array<{SPAN}>"


def _none() -> Column:
    return F.array().cast(_NONE)


def _placed(text: Column, kind: Kind) -> Column:
    """All leftmost non-overlapping matches as (start, stop, text) structs, in order."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pairs = F.zip_with(
        found,
        F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.greatest(F.size(found), F.lit(0))),
        lambda match, gap: F.struct(match.alias("text"), F.length(gap).alias("gap")),
    )

    def add(done: Column, x: Column) -> Column:
        start = done["at"] + x["gap"]
        stop = start + F.length(x["text"])
        one = F.struct(start.alias("start"), stop.alias("stop"), x["text"].alias("text"))
        return F.struct(F.concat(done["out"], F.array(one)).alias("out"), stop.alias("at"))

    empty = F.array().cast("array<struct<start:int,stop:int,text:string>>")
    return F.aggregate(pairs, F.struct(empty.alias("out"), F.lit(0).alias("at")), add)["out"]


def _near(text: Column, start: Column, stop: Column) -> Column:
    """What stands on either side of a span, in lower case."""
    first = F.greatest(start - CONTEXT, F.lit(0))
    before = F.substring(text, first + 1, start - first)
    after = F.substring(text, stop + 1, F.lit(CONTEXT))
    return F.lower(F.concat_ws(" ", before, after))


def _score(near: Column, kind: Kind) -> Column:
    """The kind's score, raised or lowered by words nearby, between 0 and 1."""
    raised = F.when(near.rlike(kind.context), 0.3).otherwise(0.0)
    lowered = F.when(near.rlike(AGAINST), 0.3).otherwise(0.0)
    return F.greatest(F.least(kind.score + raised - lowered, F.lit(1.0)), F.lit(0.0))


def _spans(text: Column, rank: int) -> Column:
    """Confirmed, scored spans of one kind; added kinds need the threshold."""
    kind = KINDS[rank]

    def span(x: Column) -> Column:
        return let(
            _near(text, x["start"], x["stop"]),
            lambda near: F.struct(
                x["start"].alias("start"),
                F.lit(rank).alias("rank"),
                x["stop"].alias("stop"),
                F.lit(kind.name).alias("kind"),
                _score(near, kind).alias("score"),
                F.regexp_extract(near, kind.context, 0).alias("context"),
            ),
        )

    confirmed = F.filter(_placed(text, kind), lambda x: _confirmed(kind.name, x["text"]))
    spans = F.transform(confirmed, span)
    if not kind.always:
        spans = F.filter(spans, lambda x: x["score"] >= THRESHOLD)
    return F.when(text.rlike(kind.sign), spans.cast(_NONE)).otherwise(_none())


def find(docs: DataFrame, name: str = "spans") -> DataFrame:
    """``docs`` with ``spans``: personal data of each text, by start and then kind.

    A span has start and stop (code points, stop exclusive), kind, rank of the
    kind, score, and the nearby word that raised it ("" without one).  A column
    of ``docs`` called ``name`` is replaced; all others stay.  Base kinds that pass their validator stay whatever the
    score.  NULL and empty texts have none; repeated rows are searched each.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    staged = docs.withColumn("__text", F.when(text.rlike("[0-9@]"), text).otherwise(F.lit("")))
    every = F.concat(*(_spans(F.col("__text"), rank) for rank in range(len(KINDS))))
    return staged.withColumn(name, F.array_sort(every)).drop("__text")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets.

    Where spans overlap, the earlier one covers what it holds.  The other
    columns stay, whatever their names; a NULL text stays NULL.
    """
    found = find(docs, "__spans")

    def step(done: Column, x: Column) -> Column:
        gap = F.greatest(x["start"] - done["at"], F.lit(0))
        mark = F.concat(F.lit("<"), x["kind"], F.lit(">"))
        added = F.concat(F.substring(F.col("text"), done["at"] + 1, gap), mark)
        covered = x["start"] < done["at"]
        return F.struct(
            F.when(covered, done["out"]).otherwise(F.concat(done["out"], added)).alias("out"),
            F.greatest(done["at"], x["stop"]).alias("at"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    done = F.aggregate("__spans", start, step)
    rest = let(done, lambda d: F.concat(d["out"], F.expr("text").substr(d["at"] + 1, F.length("text"))))
    return found.select(
        *(F.when(F.size("__spans") > 0, rest).otherwise(F.col(c)).alias(c) if c == "text" else c
          for c in docs.columns)
    )


def listed(spans: Column) -> Column:
    """kind:start:stop of spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ","
    )


def scored(spans: Column) -> Column:
    """kind:start:score:word of spans, joined by commas; the word is what raised the score."""
    said = F.transform(
        spans,
        lambda x: F.concat_ws(":", x["kind"], x["start"], F.format_number(x["score"], 1), x["context"]),
    )
    return F.array_join(said, ",")
