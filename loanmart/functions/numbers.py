"""Text -> number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: widest exact decimal used for parsing money text.
EXACT_DECIMAL = "decimal(38,18)"
# What counts as a number in text.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
NUMBER_OR_INFINITY = r"^(?i)[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity)$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _exact(col) -> Column:
    """Exact decimal; text that is no number -> null, a number that does not
    fit ``EXACT_DECIMAL`` raises (it must not look like bad text)."""
    c = _c(col)
    # looked at only where the one cast gave nothing
    wide = F.when(F.trim(c.cast("string")).rlike(NUMBER),
                  F.raise_error(F.concat(F.lit("number too wide for an exact decimal: "), c.cast("string"))).cast(EXACT_DECIMAL))
    return F.coalesce(c.try_cast(EXACT_DECIMAL), wide)


def to_decimal_exact(col) -> Column:
    """Exact decimal; unparsable text (also 'nan') -> null, too wide raises."""
    return _exact(col)


def to_decimal_rounded(col, scale: int = 4) -> Column:
    """C4: decimal rounded half-even to ``scale`` places; bad text -> null,
    too wide raises.

    A direct cast to scale 4 would round half-up, so parse exactly first.
    """
    return F.bround(_exact(col), scale)


def to_double_strict(col) -> Column:
    """Double; ANSI mode raises on bad text."""
    return _c(col).cast("double")


def to_number(col) -> Column:
    """Double; bad text -> null (pandas to_numeric coerce).  Spark's own
    cast also takes '12d' and '12f'; 'nan' has no number to keep."""
    c = _c(col)
    return F.when(F.trim(c.cast("string")).rlike(NUMBER_OR_INFINITY), c.try_cast("double"))
