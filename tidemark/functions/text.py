"""Cleaning and parsing of text cells. Everything here is a JVM-side Column expression."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import MONTHS

# Unicode white space (fixed values); Spark's one-argument trim removes the plain space only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.trim(col, F.lit(WHITESPACE))


def clean_str(col: Column) -> Column:
    """Text without surrounding white space; empty becomes null."""
    return F.nullif(strip(col.cast("string")), F.lit(""))


def clean_float(col: Column) -> Column:
    """A double, or null where the text is no number.

    Java accepts type suffixes and hexadecimal floats ("1d", "0x1p3"); those are
    not numbers here.
    """
    text = strip(col.cast("string"))
    java_only = text.rlike(r"(?i)\d[df]$|x")
    return F.when(java_only, F.lit(None).cast("double")).otherwise(text.try_cast("double"))


def month_number(col: Column) -> Column:
    """1..12 from an English month name in any case or a digit string, else null."""
    text = F.lower(strip(col))
    by_name = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), text)
    digits = F.when(text.rlike(r"^[0-9]+$"), text.try_cast("int"))
    by_digits = F.when(digits.between(1, 12), digits)
    return F.coalesce(F.nullif(by_name.cast("int"), F.lit(0)), by_digits)


def year_label(kind: Column, text: Column) -> Column:
    """A year header as text: the number 2020.0 reads "2020", "2025E" stays."""
    number = text.try_cast("double")
    whole = (kind == "n") & (number == F.floor(number))
    return F.when(whole, number.cast("bigint").cast("string")).otherwise(strip(text))


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent with one decimal; an empty whole counts as 100."""
    return F.when(whole == 0, F.lit(100.0)).otherwise(F.round(part * 100.0 / whole, 1))


def round4(col: Column) -> Column:
    """A weight with four decimals, null counting as zero."""
    return F.coalesce(col, F.lit(0.0)).cast("decimal(5,4)")


def moment(value: datetime) -> Column:
    """A time literal: an instant when the value has a zone, else a wall-clock time.

    A wall-clock literal compares with either timestamp type without a cast on the
    column, so the comparison is still pushed into the scan.
    """
    if value.tzinfo is not None:
        return F.lit(value)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_stem(path: Column) -> Column:
    """File name without its last extension; a leading dot belongs to the name."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def hash_prefix(col: Column, length: int = 12) -> Column:
    return F.left(col, F.lit(length))


def name_list(text: str) -> list[str]:
    """The names of a comma-separated list, trimmed, blanks dropped."""
    names = [name.strip() for name in text.split(",") if name.strip()]
    if not names:
        raise ValueError("the list of names must not be empty")
    return names


def contains_ignoring_case(col: Column, text: str) -> Column:
    """Case-insensitive contains; ``%`` and ``_`` in ``text`` act as wildcards.

    A backslash quotes the next character. Spark accepts a quote only before a
    wildcard or a backslash, so other quotes are resolved here.
    """
    pattern, out, i = f"%{text}%", [], 0
    while i < len(pattern):
        if pattern[i] == "\\":
            following = pattern[i + 1]
            out.append("\\" + following if following in "%_\\" else following)
            i += 2
        else:
            out.append(pattern[i])
            i += 1
    return F.ilike(col, F.lit("".join(out)))
