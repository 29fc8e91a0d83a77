"""Reusable column expressions.

All of them are compositions of built-in functions, so they stay inside
whole-stage code generation. Business times are ``TIMESTAMP_NTZ``: none of the
results depends on the session time zone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Text form of business times in the source files: yyyy-MM-dd'T'HH:mm:ss
ISO_SECONDS = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"
# Length of the display form yyyy-MM-dd HH:mm:ss
DISPLAY_LENGTH = 19
# Text accepted as a boolean, compared in lower case
TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")
# Stand-in for NULL and separator inside an attribute hash
NULL_MARK = "__NULL__"
HASH_SEPARATOR = "||"
# ----------------------------------------------------------------------------

# Money enters and leaves as DOUBLE; arithmetic happens on this exact type.
MONEY = "decimal(22,6)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Strip surrounding spaces; text that is empty afterwards becomes NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def parse_flag(c: Column | str) -> Column:
    """Read yes/no words as BOOLEAN, case-insensitively; anything else is NULL."""
    word = F.lower(_col(c))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def iso_timestamp(c: Column | str) -> Column:
    """Parse ISO text with whole seconds; every other shape is NULL.

    The pattern keeps the parse strict (``try_cast`` alone would also take bare
    dates and fractions), and casting straight to NTZ keeps local times that a
    daylight-saving zone would skip.
    """
    text = _col(c)
    return F.when(text.rlike(ISO_SECONDS), text.try_cast("timestamp_ntz"))


def format_timestamp(c: Column | str) -> Column:
    """Display form ``yyyy-MM-dd HH:mm:ss`` of a timestamp."""
    return F.left(_col(c).cast("string"), F.lit(DISPLAY_LENGTH))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from ``start`` to ``end`` as BIGINT, free of time zones."""
    return (_col(end) - _col(start)).cast("interval second").cast("bigint")


def money(c: Column | str) -> Column:
    """Exact decimal view of an amount, NULL where the type cannot hold it exactly.

    Pair it with :func:`cents` or another DOUBLE fallback, so that no amount is lost.
    """
    exact = _col(c).try_cast(MONEY)
    return F.when(exact.cast("double") == _col(c).cast("double"), exact)


def cents(exact: Column, plain: Column) -> Column:
    """DOUBLE result of exact arithmetic, rounded to cents; plain arithmetic where that is NULL."""
    return F.coalesce(F.round(exact, 2).cast("double"), F.round(plain.cast("double"), 2))


def attribute_hash(columns: Iterable[Column | str]) -> Column:
    """SHA-256 over the text of several attributes, NULL made visible."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)
