"""Column expressions for text cells: blanks, numbers written as text, clean-up.

Raw files hold every cell as text, and the cleaning rules speak of text the way
Python does (Unicode blanks, Unicode digits, ``1_000``).  The expressions below
give those meanings with built-in Spark functions only, so they stay in the JVM
and work on batch and streaming frames alike.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blanks are Unicode white space plus the four ASCII separators.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same set for patterns: ranges, since a matcher tries the members of a class one by one.
BLANK_RANGES = (
    r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}"
    r"\x{205F}\x{3000}"
)
_BLANK = rf"[{BLANK_RANGES}]"
_NOT_BLANK = rf"[^{BLANK_RANGES}]"
_DIGITS = r"\p{Nd}+(?:_\p{Nd}+)*"
_INTEGER = rf"\A{_BLANK}*[+-]?{_DIGITS}{_BLANK}*\z"
_FLOAT = (
    rf"\A{_BLANK}*[+-]?(?:"
    rf"(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    rf"|(?i:inf(?:inity)?|nan)){_BLANK}*\z"
)
# Numbers that need no reading: most cells.
_PLAIN = r"\A-?[0-9]+(?:\.[0-9]+)?\z"
# What a whole number's plain form leaves out: a plus, leading zeros, minus zero's sign.
_NUMBER_PREFIX = r"\A(?:\+|-(?=0+\z))?(-?)0*(?=[0-9])"
# The replacement mark and every code point under 32.
_UNPRINTABLE = r"[\x{FFFD}\x00-\x1F]"

TRUE_FALSE = ("TRUE", "FALSE")
RATINGS = ("1", "2", "3", "4", "5")


def strip(c: Column) -> Column:
    """Drop leading and trailing blanks."""
    return F.btrim(c, F.lit(BLANKS))


def is_blank(c: Column) -> Column:
    """True for NULL, empty and all-blank cells (never NULL)."""
    return ~F.coalesce(c.rlike(_NOT_BLANK), F.lit(False))


def sanitise(c: Column) -> Column:
    """Turn every undecodable mark and control character into one space."""
    return F.regexp_replace(c, _UNPRINTABLE, " ")


def default_na(c: Column) -> Column:
    """Blank cells become the placeholder ``NA``."""
    return F.when(is_blank(c), F.lit("NA")).otherwise(c)


@lru_cache(maxsize=1)
def _digit_alphabets() -> tuple[str, str]:
    foreign = [
        chr(p)
        for p in range(128, sys.maxunicode + 1)
        if unicodedata.category(chr(p)) == "Nd"
    ]
    return "".join(foreign), "".join(str(unicodedata.decimal(ch)) for ch in foreign)


def _number_text(c: Column) -> Column:
    """Without outer blanks and underscores, foreign digits as ASCII ones."""
    foreign, ascii_ = _digit_alphabets()
    digits = F.when(c.rlike(r"[^\x00-\x7F]"), F.translate(c, foreign, ascii_)).otherwise(c)
    return F.replace(strip(digits), F.lit("_"), F.lit(""))


def is_integer(c: Column) -> Column:
    """True when the cell reads as a whole number (never NULL)."""
    return F.coalesce(c.rlike(_INTEGER), F.lit(False))


def integer_text(c: Column) -> Column:
    """Plain decimal form of a whole number, ``007`` -> ``7``; NULL if it is none.

    Text, not a number type, so that no width limit applies.
    """
    return F.when(is_integer(c), F.regexp_replace(_number_text(c), _NUMBER_PREFIX, "$1"))


def integer_value(c: Column) -> Column:
    """Whole number as LongType, NULL if it is none or does not fit."""
    return integer_text(c).try_cast("bigint")


def is_float(c: Column) -> Column:
    """True when the cell reads as a floating-point number (never NULL)."""
    return F.coalesce(c.rlike(_FLOAT), F.lit(False))


def float_value(c: Column) -> Column:
    """Floating-point value of the cell, NULL if it is none; plain ones are cast as they stand."""
    return F.when(c.rlike(_PLAIN), c).when(is_float(c), _number_text(c)).try_cast("double")


def is_negative(c: Column) -> Column:
    """True for whole numbers below zero (never NULL); looks for a minus sign first."""
    signed = F.coalesce(c.rlike(rf"\A{_BLANK}*-"), F.lit(False))
    return signed & F.coalesce(integer_text(c).startswith("-"), F.lit(False))


def is_rating(c: Column) -> Column:
    """True for whole numbers 1..5 (never NULL); plain ones need no pattern."""
    return F.coalesce(
        c.isin(*RATINGS) | F.coalesce(integer_text(c).isin(*RATINGS), F.lit(False)), F.lit(False)
    )


def is_true_false(c: Column) -> Column:
    """True when the cell is TRUE or FALSE in any case, outer blanks aside."""
    return F.coalesce(
        c.isin(*TRUE_FALSE) | F.upper(strip(c)).isin(*TRUE_FALSE), F.lit(False)
    )


def words(c: Column) -> Column:
    """Non-empty pieces between blanks and commas."""
    return F.array_remove(F.split(c, rf"[{BLANK_RANGES},]+"), "")
