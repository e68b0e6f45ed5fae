"""Text: white space, personal data, windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .media import let

#: The 29 code points that count as white space.
SPACE = r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

_EDGE = r"(?:(?<=[\p{L}\p{N}_])(?![\p{L}\p{N}_])|(?<![\p{L}\p{N}_])(?=[\p{L}\p{N}_]))"
#: Personal data by label, in the order in which they are replaced. {b} is a word edge
#: and {s} white space, which engines spell differently.
PII = {
    "email": r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}",
    "phone": r"{b}(?:\+?\d{1,3}[-.{s}]?)?\(?\d{3}\)?[-.{s}]?\d{3}[-.{s}]?\d{4}{b}",
    "ssn": r"{b}\d{3}-\d{2}-\d{4}{b}",
    "credit_card": r"{b}(?:\d[ -]*?){13,16}{b}",
}


#: What a match begins with, looked at before anything dearer; it changes no match.
_FIRST = {"phone": r"(?=[+(\d])", "ssn": r"(?=\d)", "credit_card": r"(?=\d)"}
#: Three digits at least stand so in whatever the patterns of digits match.
_DIGITS = r"(?U)\d[ -]*\d[ -]*\d"


def pii_pattern(label: str) -> str:
    """With Unicode digits, letters and white space."""
    return "(?U)" + _FIRST.get(label, "") + PII[label].replace("{b}", _EDGE).replace("{s}", SPACE[1:-1])


def pii_mark(label: str) -> str:
    return f"[REDACTED_{label.upper()}]"


def collapse(text: Column) -> Column:
    """Runs of white space become one space; none at either end. Single spaces aren't touched."""
    other = SPACE.replace(r"\x{1C}-\x{20}", r"\x{1C}-\x{1F}")
    return F.trim(F.regexp_replace(text, f"{other}{SPACE}*| {SPACE}+", " "))


def is_blank(text: Column) -> Column:
    """Null, empty or white space alone."""
    return ~F.coalesce(text, F.lit("")).rlike("[^" + SPACE[1:])


def redact(text: Column) -> Column:
    """Replace personal data, pattern by pattern in order. Texts without @, or without digits, skip the
    patterns that need them."""

    def replaced(t: Column, *labels: str) -> Column:
        for label in labels:
            t = F.regexp_replace(t, pii_pattern(label), F.lit(pii_mark(label)))
        return t

    def digits(t: Column) -> Column:
        return F.when(t.rlike(_DIGITS), replaced(t, *(k for k in PII if k != "email"))).otherwise(t)

    return let(let(text, lambda t: F.when(F.contains(t, F.lit("@")), replaced(t, "email")).otherwise(t)), digits)


def count_mark(text: Column, label: str) -> Column:
    """How often a redaction mark stands in a text."""
    mark = pii_mark(label)
    return ((F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))) / len(mark)).cast("long")


def text_windows(text: Column, window: int, overlap: int) -> Column:
    """array<struct<start,end>> of code points. After the window that reaches the end, one more of the
    overlap's length follows whenever the text is longer than that; an empty text has one window."""
    n = F.length(F.coalesce(text, F.lit("")))
    return spans(n, window, overlap)


def spans(n: Column, window: float, overlap: float) -> Column:
    """array<struct<start,end>> over [0, n): windows window apart less overlap, cut at n, and the tail.
    An overlap of a window or more is none; without overlap there is no tail."""
    overlap = overlap if overlap < window else type(overlap)(0)
    step = window - overlap

    def plain(n: Column) -> Column:
        zero, last = n - n, F.greatest(F.ceil(n / step).cast("int"), F.lit(1)) - 1
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.struct((zero + i * step).alias("start"), F.least(zero + i * step + window, n).alias("end")))

    def cut(n: Column) -> Column:
        zero = n - n  # of the type of n
        last = F.greatest(F.ceil((n - overlap) / step).cast("int"), F.lit(1)) - 1
        own = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct((zero + i * step).alias("start"), F.least(zero + i * step + window, n).alias("end")))
        tail = F.array(F.struct((n - overlap).alias("start"), n.alias("end")))
        return F.when(n <= overlap, F.array(F.struct(zero.alias("start"), n.alias("end")))).otherwise(F.concat(own, tail))

    return let(n, cut if overlap > 0 else plain)
