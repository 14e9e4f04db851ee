"""Text cleaning expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed from money and percent text.
MONEY_CHARS_WITH_BLANK = "$,% "
MONEY_CHARS = "$,%"
# Quote characters removed from all text (funded report).
QUOTE_CHARS = "'\""
# Text used for a missing part of the case hash key.
HASH_NULL_TEXT = "None"
HASH_SEPARATOR = "-"

# Every character Python's str.strip() removes (str.isspace):
# TAB LF VT FF CR, FS GS RS US, SPACE, NEL, NO-BREAK SPACE, OGHAM SPACE MARK,
# EN QUAD .. HAIR SPACE (U+2000-U+200A), LINE SEPARATOR, PARAGRAPH SEPARATOR,
# NARROW NO-BREAK SPACE, MEDIUM MATHEMATICAL SPACE, IDEOGRAPHIC SPACE.
# SQL trim() only removes blanks; btrim over this set is a plain scan, no regex.
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                 "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                 "\u2028\u2029\u202f\u205f\u3000")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """Trim Unicode whitespace at both ends; null stays null."""
    return F.btrim(_c(col), F.lit(PY_WHITESPACE))


def clean_symbols(col, chars: str = MONEY_CHARS_WITH_BLANK) -> Column:
    """Drop every char in ``chars`` anywhere, then trim."""
    return py_strip(F.translate(_c(col), chars, ""))


def blank_to_null(col) -> Column:
    """C9: '' -> null."""
    return F.nullif(_c(col), F.lit(""))


def null_token_to_null(col, token: str = "null") -> Column:
    """C11: the whole value 'null' -> null."""
    return F.nullif(_c(col), F.lit(token))


def strip_quotes(col) -> Column:
    """Remove single and double quotes."""
    return F.translate(_c(col), QUOTE_CHARS, "")


def recode(col, mapping: Mapping[str, str]) -> Column:
    """Replace whole values by the mapping, others kept."""
    c = _c(col)
    expr = None
    for old, new in mapping.items():
        expr = (F.when(c == old, F.lit(new)) if expr is None
                else expr.when(c == old, F.lit(new)))
    return c if expr is None else expr.otherwise(c)


def status_is(col, status: str) -> Column:
    """F8: case-insensitive, whitespace-trimmed equality; null -> false."""
    return F.coalesce(F.lower(py_strip(col)) == F.lit(status.lower()), F.lit(False))


def full_name(first, last, default_blank: bool = False) -> Column:
    """C17: 'first last'.  Alerts give null when a part is null; the webhook
    form defaults the parts to ''."""
    f, l_ = _c(first), _c(last)
    if default_blank:
        f, l_ = F.coalesce(f, F.lit("")), F.coalesce(l_, F.lit(""))
    return F.concat(f, F.lit(" "), l_)


def case_hash(loan_number, draw_id) -> Column:
    """SHA-256 hex of 'loan-draw', null parts spelled 'None'."""
    def part(c):
        return F.coalesce(_c(c).cast("string"), F.lit(HASH_NULL_TEXT))
    return F.sha2(F.concat(part(loan_number), F.lit(HASH_SEPARATOR), part(draw_id)), 256)


def has_label(array_col, label: str) -> Column:
    """F9 (Q25): membership in an array of labels; null array -> false."""
    return F.coalesce(F.array_contains(_c(array_col), F.lit(label)), F.lit(False))
