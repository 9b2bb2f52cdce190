"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Spark expressions only.  A text is split at a pattern's matches; gaps and matches, scanned once side by
side, give each match its place in code points, so a whole text of any length is searched.  Kinds:

* ``email``, ``ip`` (parts at most 255), ``card`` (14 to 19 digits, Luhn), ``phone`` (10 to 15 digits): base
  kinds; every match that passes its check is kept, whatever its score;
* ``iban`` (mod-97) and ``ssn`` (no checksum, so a context word nearby is needed): added by the score.

The score is the kind's prior, plus ``CONTEXT_BONUS`` when a word of the kind's list stands within
``CONTEXT_CHARS`` code points before or after the match in the text between matches.

Defined cases: a null text counts as empty and has no spans; repeated rows are searched each; an empty table
gives an empty result; input columns named like an output column are replaced.  Patterns use possessive
repeats and start only where a run starts, so that long runs neither overflow the stack nor take
quadratic time; they match what the plain patterns match.  Places are summed in blocks of ``BLOCK`` matches, and
texts are cut by blocks of ``TEXT_BLOCK`` code points, so that the time follows the text and not its square.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenweave.llm.common import drop_columns_ignoring_case

CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.3
THRESHOLD = 0.5
BLOCK = 64
TEXT_BLOCK = 4096
SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string,score:double>"


@dataclass(frozen=True)
class Kind:
    """``needs``: a pattern every text with a match contains, checked first because it is cheap."""

    name: str
    pattern: str
    needs: str
    prior: float
    base: bool
    words: str


# The base kinds' patterns match what the plain ones in their comments match.
KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", 0.9, True, "e-?mail|mail|contact|write"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         r"[0-9]\.[0-9]", 0.6, True, "ip|address|host|server|login"),
    # [0-9]([\x20-]?[0-9])+ of 14 to 19 digits: the runs of that many digits
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
         r"[0-9](?:[ -]?[0-9]){13}", 0.7, True, "card|credit|visa|payment|account"),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", 0.6, True, "phone|call|tel|mobile|fax"),
    # written together, or in groups of four with a tail that ends in a digit
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{0,2}[0-9])?)",
         r"[A-Z]{2}[0-9]{2}", 0.8, False, "iban|bank|account|transfer"),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"[0-9]{3}-[0-9]{2}-", 0.3, False, "ssn|social security|tax"),
)
BASE = [k.name for k in KINDS if k.base]


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once (an outer expression is computed for each element of a lambda)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def before_each(values: Column, op) -> Column:
    """For each of an array's numbers (at least 0) what ``op``, a sum or a maximum, makes of those before it.

    ``aggregate`` copies what it carries at every step, so only a block's results are carried, and then one for each
    block.
    """
    zero = F.lit(0).cast("bigint")
    grown = lambda items, start: F.aggregate(
        items, F.array(start), lambda acc, v: F.concat(acc, F.array(op(F.element_at(acc, -1), v))))
    some = lambda items, grow: F.slice(grow, F.lit(1), F.size(items))

    def blocks(x: Column) -> Column:
        last = F.floor(F.greatest(F.size(x) - 1, F.lit(0)) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(x, b * BLOCK + 1, F.lit(BLOCK)))

    def joined(c: Column) -> Column:
        wholes = F.transform(c, lambda block: F.aggregate(block, zero, op))
        return F.flatten(F.zip_with(c, some(c, grown(wholes, zero)), lambda block, start: some(block, grown(block, start))))

    return bound(values, lambda x: bound(blocks(x), joined))


def mod97(iban: Column) -> Column:
    """Remainder of an account number by 97: the first four characters go last, letters count 10 to 35."""
    s = F.replace(iban, F.lit(" "), F.lit(""))
    chars = F.split(F.concat(F.substr(s, F.lit(5)), F.substring(s, 1, 4)), "")
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    step = lambda acc, c: (acc * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97
    return F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0).cast("int"), lambda a, c: step(a, c).cast("int"))


def confirmed(kind: str, match: Column) -> Column:
    """Whether a match passes the kind's check; a failing one is dropped."""
    if kind == "ip":  # four parts of at most 255, leading zeros allowed
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.call_function("luhn_check", _digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "iban":
        return mod97(match) == 1
    return F.lit(True)


def kind_spans(text: Column, kind: Kind, rank: int) -> Column:
    """Spans of one kind in ``text``, by start."""
    pattern = F.lit(kind.pattern)
    gaps = F.split(text, kind.pattern, -1)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    # the i-th match stands between the i-th gap and the next one; the last gap has no match
    steps = F.zip_with(F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), m.alias("hit"))),
                       F.slice(gaps, F.lit(2), F.size(gaps)),
                       lambda s, after: F.struct(s["gap"].alias("gap"), s["hit"].alias("hit"), after.alias("after")))
    near = rf"(?i)(?:^|[^A-Za-z])(?:{kind.words})(?:[^A-Za-z]|$)"

    def candidate(s: Column, at: Column) -> Column:
        start = at + F.length(s["gap"])
        context = (F.right(s["gap"], F.lit(CONTEXT_CHARS)).rlike(near)
                   | F.left(F.coalesce(s["after"], F.lit("")), F.lit(CONTEXT_CHARS)).rlike(near))
        score = F.least(F.lit(kind.prior) + F.when(context, CONTEXT_BONUS).otherwise(0.0), F.lit(1.0))
        return F.struct(s["hit"].alias("hit"), start.cast("bigint").alias("start"),
                        (start + F.length(s["hit"])).cast("bigint").alias("end"), score.alias("score"))

    def kept(c: Column) -> Column:
        good = c["hit"].isNotNull() & confirmed(kind.name, c["hit"])
        return good if kind.base else good & (c["score"] >= THRESHOLD)

    def located(x: Column) -> Column:
        sizes = F.transform(x, lambda s: (F.length(s["gap"]) + F.coalesce(F.length(s["hit"]), F.lit(0))).cast("bigint"))
        return F.transform(F.filter(F.zip_with(x, before_each(sizes, lambda a, v: a + v), candidate), kept), lambda c: F.struct(
            c["start"].alias("start"), F.lit(rank).alias("rank"), c["end"].alias("end"), F.lit(kind.name).alias("kind"),
            c["score"].alias("score")).cast(SPAN))

    return F.when(text.rlike(kind.needs), bound(steps, located)).otherwise(F.array().cast(f"array<{SPAN}>"))


def find_pii(docs: DataFrame, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """``docs`` with ``out_col``: spans sorted by start, then kind (code points, end exclusive)."""
    base = drop_columns_ignoring_case(docs, [out_col])
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = F.array_sort(F.concat(*[kind_spans(text, k, i) for i, k in enumerate(KINDS)]))
    return base.withColumn(out_col, spans)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets; overlapping spans become one.

    A null text stays null.
    """
    found = find_pii(docs, text_col, "_pii_spans")

    def cut(s: Column, at: Column) -> Column:
        inside = s["start"] < at  # an overlapping span hides its rest: an empty piece without a tag
        return F.struct(F.when(inside, s["end"]).otherwise(at).alias("from"),
                        F.when(inside, s["end"]).otherwise(s["start"]).alias("to"),
                        F.when(inside, F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).alias("tag"))

    text = F.col(text_col)
    cuts = bound(F.col("_pii_spans"), lambda x: F.zip_with(
        x, before_each(F.transform(x, lambda s: s["end"]), lambda a, v: F.greatest(a, v)), cut))
    tail = F.coalesce(F.array_max(F.transform("_pii_spans", lambda s: s["end"])), F.lit(0))
    # a place in a long text is found by counting from its start, so a piece is cut from the blocks that hold it
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0))

    def piece(held: Column, c: Column) -> Column:
        first, last = (F.floor(x / TEXT_BLOCK).cast("int") for x in (c["from"], F.greatest(c["from"], c["to"] - 1)))
        own = F.array_join(F.slice(held, first + 1, last - first + 1), "")
        start = (c["from"] - first * TEXT_BLOCK + 1).cast("int")
        return F.concat(F.substr(own, start, (c["to"] - c["from"]).cast("int")), c["tag"])

    pieces = bound(blocks, lambda held: F.concat(
        F.transform(cuts, lambda c: piece(held, c)), F.array(F.substr(text, (tail + 1).cast("int")))))
    return (found.withColumn(text_col, F.when(F.size("_pii_spans") == 0, text).otherwise(F.array_join(pieces, "")))
            .drop("_pii_spans"))
