"""Cell predicates and literal parsers (F1-F4, P3 inputs).

All predicates are built-in Spark expressions (regex + try_cast +
try_to_timestamp), so they run inside whole-stage codegen on the executors.

The literal rules follow Python's ``str.strip``, ``int``, ``float`` and
``datetime.strptime`` as used by the profiled pipeline:

* a cell is *missing* when it is NULL or only whitespace;
* an *int* literal is optional sign, ASCII digits, single underscores between
  digits, surrounding whitespace allowed (``int('1_000')`` is valid,
  ``int('1.0')`` and ``int('1e3')`` are not);
* a *float* literal adds a fraction, an exponent, and nan / inf / infinity
  (case-insensitive); ``'1d'`` and ``'1f'`` are not floats;
* a *date* must match one of four strptime formats exactly (no surrounding
  whitespace, four-digit year, month/day with one or two digits) and be a real
  calendar day.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must agree with the reference behaviour, do not edit):
# the whitespace characters Python's str.strip removes, the literal grammars
# of int() / float(), and the four date formats tried in this order:
# %Y-%m-%d, %m/%d/%Y, %d/%m/%Y, %Y/%m/%d.
# ---------------------------------------------------------------------------
WS_CLASS = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
DIGITS = r"[0-9]+(?:_[0-9]+)*"
INT_RE = rf"^{WS_CLASS}*[+-]?{DIGITS}{WS_CLASS}*$"
FLOAT_RE = (
    rf"(?i)^{WS_CLASS}*[+-]?(?:(?:{DIGITS})(?:\.(?:{DIGITS})?)?|\.{DIGITS})(?:e[+-]?{DIGITS})?{WS_CLASS}*$"
    rf"|^{WS_CLASS}*[+-]?(?:nan|inf|infinity){WS_CLASS}*$"
)
BLANK_RE = rf"^{WS_CLASS}*$"
# Same grammars with the literal (whitespace stripped) as group 1, so one
# regexp_extract both validates and strips.
INT_CAPTURE = rf"^{WS_CLASS}*([+-]?{DIGITS}){WS_CLASS}*$"
FLOAT_CAPTURE = (
    rf"(?i)^{WS_CLASS}*([+-]?(?:(?:{DIGITS})(?:\.(?:{DIGITS})?)?|\.{DIGITS})(?:e[+-]?{DIGITS})?"
    rf"|[+-]?(?:nan|inf|infinity)){WS_CLASS}*$"
)
STRIP_RE = rf"^{WS_CLASS}+|{WS_CLASS}+$"
# The same whitespace set as single characters, and the characters a numeric
# literal can start with: cheap first-character gates in front of the regexes.
WS_CHARS = ([" ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", "\u1680"]
            + [chr(c) for c in range(0x2000, 0x200B)] + ["\u2028", "\u2029", "\u202f", "\u205f", "\u3000"])
DIGIT_CHARS = [str(d) for d in range(10)]
NUMBER_START_CHARS = DIGIT_CHARS + ["+", "-", ".", "n", "N", "i", "I"] + WS_CHARS

# (name, Spark datetime pattern, exact shape) in the order they are tried.
# A day may also be a space and one digit (strptime's %d accepts " 5"); the
# year is four digits and not 0000 (Python's calendar starts at year 1).  Months
# and days out of range are left to no parser, which throws for each such value.
MONTH = "(?:0?[1-9]|1[0-2])"
DAY = "(?:0?[1-9]|[12][0-9]|3[01]| [1-9])"
YEAR = "(?!0000)[0-9]{4}"
DATE_FORMATS = [
    ("%Y-%m-%d", "y-M-d", f"^{YEAR}-{MONTH}-{DAY}$"),
    ("%m/%d/%Y", "M/d/y", f"^{MONTH}/{DAY}/{YEAR}$"),
    ("%d/%m/%Y", "d/M/y", f"^{DAY}/{MONTH}/{YEAR}$"),
    ("%Y/%m/%d", "y/M/d", f"^{YEAR}/{MONTH}/{DAY}$"),
]

NUMERIC_TYPES = ("int", "float")
TYPE_NAMES = ("int", "float", "date", "string")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def first_char(col) -> Column:
    return F.substring(_c(col), 1, 1)


def is_missing(col) -> Column:
    """NULL or blank after strip (the regex only runs on values that start
    with whitespace)."""
    c = _c(col)
    return c.isNull() | (c == "") | (first_char(c).isin(WS_CHARS) & c.rlike(BLANK_RE))


def may_be_number(col) -> Column:
    """Necessary condition for an int/float literal: its first character."""
    return first_char(col).isin(NUMBER_START_CHARS)


def may_be_date(col) -> Column:
    """Necessary condition for a date shape: it starts with a digit (or, for
    a space-padded day first, a space)."""
    return first_char(col).isin([*DIGIT_CHARS, " "])


def is_date_format(col, i: int) -> Column:
    """F4 for one format: exact shape and a real calendar day."""
    _, pattern, shape = DATE_FORMATS[i]
    c = _c(col)
    return F.coalesce(
        c.rlike(shape) & F.try_to_timestamp(F.replace(c, F.lit(" "), F.lit("")), F.lit(pattern)).isNotNull(),
        F.lit(False),
    )


def is_date_literal(col) -> Column:
    """the value parses with any of the four formats."""
    out = is_date_format(col, 0)
    for i in range(1, len(DATE_FORMATS)):
        out = out | is_date_format(col, i)
    return out
