"""String normalisers, all JVM-side column expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode White_Space characters (Unicode standard property list): the set a
# whitespace-aware TRIM removes; Spark's one-argument trim drops only U+0020.
UNICODE_WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Characters whose Unicode title case is not their upper case (SpecialCasing):
# the only one in Latin-1 is the sharp s (title "Ss", upper "SS").
TITLECASE_SPECIAL = {"ß": "Ss"}

# Word delimiters of the modelled INITCAP besides whitespace (fixed value).
INITCAP_DELIMITERS = "[](){}/|\\<>!?@\"^#$&~_,.:;*%+-"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utrim(c) -> Column:
    """Trim leading/trailing Unicode whitespace."""
    return F.trim(_c(c), F.lit(UNICODE_WHITESPACE))


def norm(c) -> Column:
    """``lower(trim(x))`` with Unicode whitespace: the identity-matching key."""
    return F.lower(utrim(c))


def is_blank(c) -> Column:
    """NULL or whitespace only."""
    return _c(c).isNull() | (utrim(c) == F.lit(""))


def non_blank(c) -> Column:
    return _c(c).isNotNull() & (utrim(c) != F.lit(""))


def _initcap_piece_pattern() -> str:
    delims = "".join("\\" + ch if ch in "[]\\^-" else ch for ch in INITCAP_DELIMITERS)
    cls = "\\s" + delims
    return "(?U)[^" + cls + "]*[" + cls + "]?"


_PIECE = _initcap_piece_pattern()


def _title_char(ch: Column) -> Column:
    expr = None
    for k, v in TITLECASE_SPECIAL.items():
        expr = F.when(ch == F.lit(k), F.lit(v)) if expr is None else expr.when(ch == F.lit(k), F.lit(v))
    return expr.otherwise(F.upper(ch))


def proper_case(c) -> Column:
    """Title-case the first character after every delimiter, rest unchanged.

    The string is cut into "word + one delimiter" pieces, each piece gets a
    title-case first character (``upper`` except where Unicode title case
    differs), and the pieces are glued back together.
    """
    pieces = F.regexp_extract_all(_c(c), F.lit(_PIECE), 0)
    capped = F.transform(
        pieces, lambda w: F.concat(_title_char(w.substr(1, 1)), w.substr(F.lit(2), F.length(w)))
    )
    return F.when(_c(c).isNull(), F.lit(None).cast("string")).otherwise(
        F.array_join(capped, "")
    )


def display_name(c) -> Column:
    """``initcap(lower(trim(x)))``."""
    return proper_case(norm(c))


def digits_only(c) -> Column:
    return F.regexp_replace(_c(c), "[^0-9]", "")


def surrogate_id(c) -> Column:
    """Stable id of a ticketing-only contact: prefix + md5 hex of the email key."""
    from flocklens.config import TICKET_ID_PREFIX

    return F.concat(F.lit(TICKET_ID_PREFIX), F.md5(_c(c)))


def full_name_key(first, last) -> Column:
    """``norm(first) || ' ' || norm(last)`` (NULL if either is NULL)."""
    return F.concat(norm(first), F.lit(" "), norm(last))


def bigram_set(c) -> Column:
    """Distinct two-character substrings of ``c`` (space included).

    A one-character string has none; ``sequence`` is clamped at 1 so it never
    counts down, and the length filter removes the one-character tail piece.
    """
    s = _c(c)
    starts = F.sequence(F.lit(1), F.greatest(F.length(s) - 1, F.lit(1)))
    grams = F.transform(starts, lambda i: s.substr(i, F.lit(2)))
    return F.array_distinct(F.filter(grams, lambda g: F.length(g) == 2))


# SQL: the bigram of ``name`` at place i (from 1) as a number, one for one: both
# code points, of at most 21 bits each
BIGRAM_CODE = "i -> shiftleft(CAST(ascii(substr(name, i, 1)) AS BIGINT), 21) + ascii(substr(name, i + 1, 1))"
