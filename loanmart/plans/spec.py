"""ReportSpec: a declarative description of one report's cleaning, compiled
into a single ``select`` (one Project over the scan, inside whole-stage
codegen; no chain of ``withColumn``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmart.functions.dates import DEFAULT_DATE_FORMAT, pacific_stamp, parse_date, parse_timestamp
from loanmart.functions.numbers import to_decimal_exact, to_decimal_rounded
from loanmart.functions.text import MONEY_CHARS_WITH_BLANK, clean_symbols
from loanmart.plans.headings import HEADING_RENAMES

STAMP_COLUMN = "timestamp"


def q(name: str) -> str:
    """Back-quote a column name (headings hold blanks, '%', '/', quotes)."""
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class ReportSpec:
    name: str                                   # catalogue name of the report
    key: str = "Loan Number"                    # F1: rows without it are totals
    pre_renames: Mapping[str, str] = field(default_factory=dict)   # P2
    clean: Sequence[str] = ()                   # C1/C2 targets
    strip_chars: str = MONEY_CHARS_WITH_BLANK   # C1 (with blank) or C2
    text: Sequence[str] = ()                    # C8
    timestamps: Sequence[str] = ()              # D1
    dates: Sequence[str] = ()                   # D2
    decimals: Sequence[str] = ()                # C4 / C5
    decimal_scale: int | None = 4               # None: exact (C5)
    date_format: str = DEFAULT_DATE_FORMAT
    renames: Mapping[str, str] = field(default_factory=lambda: HEADING_RENAMES)

    def column_expr(self, name: str) -> Column:
        raw = F.col(q(name))
        # Q26: dates are parsed from the raw text, never from cleaned text.
        if name in self.timestamps:
            return parse_timestamp(raw, self.date_format)
        if name in self.dates:
            return parse_date(raw, self.date_format)
        c = clean_symbols(raw, self.strip_chars) if name in self.clean or name in self.decimals else raw
        if name in self.decimals:
            return (to_decimal_exact(c) if self.decimal_scale is None
                    else to_decimal_rounded(c, self.decimal_scale))
        if name in self.text:
            return c.cast("string")
        return c

    def required(self) -> list[str]:
        cols = [self.key, *self.clean, *self.text, *self.timestamps, *self.dates, *self.decimals]
        return list(dict.fromkeys(cols))


def apply_spec(df: DataFrame, spec: ReportSpec, as_of=None) -> DataFrame:
    """F1 + P2 + C* + D* + P1 (+ P12 when ``as_of`` is given) as one Project.

    Missing listed columns raise Spark's own unresolved-column error at
    analysis time; extra columns pass through unchanged.
    """
    cols = [spec.pre_renames.get(c, c) for c in df.columns]
    source = {spec.pre_renames.get(c, c): c for c in df.columns}
    missing = [c for c in spec.required() if c not in source]
    if missing:
        raise ValueError(f"report '{spec.name}' lacks columns: {missing}")
    out = []
    for name in cols:
        expr = spec.column_expr(name)
        if name != source[name]:
            expr = _rebind(spec, name, source[name])
        out.append(expr.alias(spec.renames.get(name, name)))
    if as_of is not None and STAMP_COLUMN not in cols:
        out.append(pacific_stamp(as_of).alias(STAMP_COLUMN))
    return df.where(F.col(q(source[spec.key])).isNotNull()).select(*out)


def _rebind(spec: ReportSpec, new: str, old: str) -> Column:
    """Expression for a pre-renamed column, reading the landed name."""
    shadow = ReportSpec(
        name=spec.name, key=spec.key, clean=_swap(spec.clean, new, old),
        strip_chars=spec.strip_chars, text=_swap(spec.text, new, old),
        timestamps=_swap(spec.timestamps, new, old), dates=_swap(spec.dates, new, old),
        decimals=_swap(spec.decimals, new, old), decimal_scale=spec.decimal_scale,
        date_format=spec.date_format, renames=spec.renames)
    return shadow.column_expr(old)


def _swap(names: Sequence[str], new: str, old: str) -> tuple[str, ...]:
    return tuple(old if n == new else n for n in names)
