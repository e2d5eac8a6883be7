"""Text to typed columns.

Numbers follow the grammar of Python's ``float()`` (underscores between digits,
``nan``/``inf`` words, surrounding Unicode white space) for ASCII digits; Spark's own
cast differs on ``1_000``, ``1d`` and ``+nan``, so one pattern guards every
cast. Each function refers to its input as few times as it can, so that the pattern
runs once per value.
Missing values leave this module as NULL, never as NaN.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters float() skips around a number, and the four separators
# str.strip() removes besides.
_UNICODE_SPACES = (
    r"\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
NUMBER_SPACE = rf"[\x{{09}}-\x{{0d}}\x{{20}}{_UNICODE_SPACES}]"
WHITE_SPACE = rf"[\x{{09}}-\x{{0d}}\x{{1c}}-\x{{20}}{_UNICODE_SPACES}]"
_DIGITS = r"[0-9](?:_?[0-9])*+"
_DECIMAL = rf"[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
# The words float() reads as infinity and not-a-number, any case, any sign.
# Group 1 is the number without surrounding white space; a NaN loses its sign.
NUMBER = (
    rf"^{NUMBER_SPACE}*+(?:[+-](?=[nN]))?"
    rf"({_DECIMAL}|(?i:[+-]?inf(?:inity)?|nan)){NUMBER_SPACE}*+\z"
)
# Quotes, brackets and the space, removed before a cast.
MARKUP = "\"'[] "
# Words read as false and true.
FALSE_WORDS = ("False", "false", "FALSE", "F", "f")
TRUE_WORDS = ("True", "true", "TRUE", "T", "t")


def strip(c: Column) -> Column:
    """Trim white space at both ends, as str.strip() does."""
    return F.regexp_replace(c, rf"^{WHITE_SPACE}+|{WHITE_SPACE}+\z", "")


def strip_markup(c: Column) -> Column:
    """Delete quotes, square brackets and every space, then trim."""
    return strip(F.translate(c, MARKUP, ""))


def parse_number(c: Column) -> Column:
    """DOUBLE value of the text, NaN and infinities kept; NULL if it is no number."""
    # No match gives NULL here, which spares the cast a failure on every junk value.
    number = F.get(F.regexp_extract_all(c, F.lit(NUMBER), F.lit(1)), F.lit(0))
    return F.translate(number, "_", "").try_cast("double")


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def _is_infinite(number: Column) -> Column:
    return F.abs(number) == F.lit(float("inf"))


def is_number(c: Column) -> Column:
    return parse_number(c).isNotNull()


def is_nan(c: Column) -> Column:
    return F.coalesce(F.isnan(parse_number(c)), F.lit(False))


def is_finite_number(c: Column) -> Column:
    n = parse_number(c)
    return F.coalesce(~F.isnan(n) & ~_is_infinite(n), F.lit(False))


def is_integer(c: Column) -> Column:
    n = parse_number(c)
    return F.coalesce(~F.isnan(n) & ~_is_infinite(n) & (n == F.rint(n)), F.lit(False))


def is_boolean(c: Column) -> Column:
    return F.coalesce(
        parse_number(c).isin(0.0, 1.0) | strip_markup(c).isin(*FALSE_WORDS, *TRUE_WORDS),
        F.lit(False),
    )


def cast_float(c: Column) -> Column:
    """DOUBLE after markup removal; junk and NaN give NULL."""
    return nan_to_null(parse_number(strip_markup(c)))


def cast_int(c: Column) -> Column:
    """Whole number as DOUBLE (missing values make it nullable); others NULL."""
    n = cast_float(c)
    return F.when(~_is_infinite(n) & (n == F.rint(n)), n)


def cast_bool(c: Column) -> Column:
    """0 or 1 as INT; anything that is neither true nor false is NULL."""
    s = strip_markup(c)
    n = parse_number(s)
    return F.when((n == 0) | s.isin(*FALSE_WORDS), F.lit(0)).when(
        (n == 1) | s.isin(*TRUE_WORDS), F.lit(1)
    )


def cast_string(c: Column) -> Column:
    """The text itself, or NULL where it spells a NaN."""
    return F.when(~is_nan(c), c)


CASTS = {"bool": cast_bool, "int": cast_int, "float": cast_float, "string": cast_string}


def field(text: Column, name: str, kind: str = "string", prefix_match: bool = False) -> Column:
    """Typed value of the first ``name: value`` line; NULL when there is none.

    The value ends at the next colon or line end. ``prefix_match`` accepts any line
    that merely starts with ``name``.
    """
    rest = r"[^:\n]*" if prefix_match else r"[ \t]*"
    pattern = rf"(?m)^{re.escape(name)}{rest}:([^:\n]*)"
    first = F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(0))
    return CASTS[kind](strip(first))
