"""Column expressions for coupon text: discount rate, minimum spend, date.

Every function takes and returns a ``Column`` and compiles to plain Catalyst
expressions (substring, pattern guard, guarded ``try_cast``), so a projection that
uses them stays inside whole-stage codegen and needs no Python worker.

Text-to-number casts always go through a pattern guard: Spark's cast accepts
Java literal suffixes (``'20f'`` -> 20.0, ``'20d'`` -> 20.0) and words such as
``'Infinity'``, which are not numbers in the coupon data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (define what counts as a number and as a missing token).
DECIMAL_PATTERN = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"
INTEGER_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
MISSING_TOKENS = ("", "null", "nan")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c, missing_tokens=MISSING_TOKENS) -> Column:
    """Text form of ``c`` with missing tokens (compared trimmed, lower case) as NULL."""
    s = _col(c).cast("string")
    tokens = [t.lower() for t in missing_tokens]
    if not tokens:
        return s
    return F.when(~F.lower(F.trim(s)).isin(tokens), s)


def to_double(c) -> Column:
    """Decimal text -> DOUBLE; NULL unless the whole text is a plain decimal number."""
    s = _col(c)
    return F.when(s.rlike(DECIMAL_PATTERN), s.try_cast("double"))


def to_int(c) -> Column:
    """Integer text -> INT; NULL unless the text is a plain integer in INT range."""
    s = _col(c)
    return F.when(s.rlike(INTEGER_PATTERN), s.try_cast("int"))


def _has(c: Column, ch: str) -> Column:
    return F.instr(c, ch) > 0


def _head(c: Column) -> Column:
    # everything before the last colon ("" without one): the text minus its tail and colon
    return F.left(c, F.length(c) - F.length(_tail(c)) - F.lit(1))


def _tail(c: Column) -> Column:
    # everything after the last colon
    return F.substring_index(c, ":", -1)


def discount_rate(raw) -> Column:
    """``'a:b'`` (spend a, b off) -> (a - b) / a; plain number -> itself.

    Splits at the last colon; a zero or unparsable part gives NULL.
    """
    s = _col(raw)
    front = to_double(_head(s))
    behind = to_double(_tail(s))
    return F.when(_has(s, ":"), F.try_divide(front - behind, front)).otherwise(to_double(s))


def min_spend(raw) -> Column:
    """``'a:b'`` -> a; text with a point (a plain rate) -> 0.0; else the number itself."""
    s = _col(raw)
    return (
        F.when(_has(s, ":"), to_double(_head(s)))
        .when(_has(s, "."), F.lit(0.0))
        .otherwise(to_double(s))
    )


def date_int(raw) -> Column:
    """Date text -> yyyymmdd INT.

    With a dash, every occurrence of the fifth character is removed first (so
    ``'2016-01-15'`` -> 20160115 and ``'2016-1-5'`` -> 201615, unpadded); otherwise
    the text is read as an integer.
    """
    s = _col(raw)
    stripped = F.replace(s, F.substring(s, 5, 1), F.lit(""))
    return F.when(_has(s, "-"), to_int(stripped)).otherwise(to_int(s))


def date_day(raw) -> Column:
    """Date text -> DATE for day arithmetic (``yyyyMMdd`` or ``yyyy-MM-dd``)."""
    s = F.trim(_col(raw))
    return F.coalesce(F.try_to_date(s, "yyyyMMdd"), F.try_to_date(s, "yyyy-MM-dd"))
