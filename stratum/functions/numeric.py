"""Numeric expressions: rounding, coercion, money parsing, ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half(col, digits: int) -> Column:
    """``round(x * 10^d) / 10^d`` with negative zero turned into zero.

    Rounds the binary value half away from zero, which is what SQL engines
    that scale-then-round produce; Spark's decimal ``round`` differs on
    values such as 1.005.
    """
    p = float(10 ** digits)
    return F.round(_c(col) * F.lit(p), 0) / F.lit(p) + F.lit(0.0)


# optional sign, digits with an optional fraction, optional exponent
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def coerce_numeric(col, to: str = "bigint") -> Column:
    """Parse text as a decimal number, null when it is not one.

    Type suffixes and hexadecimal forms, which the JVM would accept (``7D``,
    ``12f``, ``0x1p3``), are not numbers.  ``double``: any number text.
    ``bigint``: integral values in range, others null; use ``double`` where
    fractions may occur.
    """
    text = _c(col).cast("string")
    num = F.when(text.rlike(NUMBER), text.try_cast("double"))
    if to == "double":
        return num
    fits = (num == F.floor(num)) & (F.abs(num) < F.lit(9.2e18))
    return F.when(fits, num.cast("bigint"))


def numeric_types(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """``bigint`` or ``double`` for each text column, decided by its values in one aggregate over all of them.

    A column whose numbers are all whole and in range is ``bigint``; one fraction (or a number beyond 9.2e18) makes it
    ``double``, so that no value is lost.  Text that is no number does not count; a column without numbers is ``bigint``.
    """
    if not columns:
        return {}
    wide = [F.max(coerce_numeric(c, "double").isNotNull() & coerce_numeric(c, "bigint").isNull()).alias(f"_{i}")
            for i, c in enumerate(columns)]
    found = df.agg(*wide).first()
    return {c: "double" if found[i] else "bigint" for i, c in enumerate(columns)}


def parse_money(col, scale: float = 1e9, strict: bool = True) -> Column:
    """``'$225.0B'`` -> 225.0 * scale.  Only a ``B`` suffix is understood.

    ``strict`` raises on text that is not a number (ANSI cast), otherwise
    such text gives null.
    """
    text = F.replace(F.replace(_c(col), F.lit("$"), F.lit("")), F.lit("B"), F.lit(""))
    num = text.cast("double") if strict else text.try_cast("double")
    return num * F.lit(float(scale))


def safe_pct(num, den, digits: int = 2) -> Column:
    """``(num / den) * 100`` rounded, 0 when ``den`` is 0 or null."""
    ratio = F.try_divide(_c(num).cast("double"), _c(den).cast("double")) * F.lit(100.0)
    return round_half(F.coalesce(ratio, F.lit(0.0)), digits)


def kb_text(value, unit) -> Column:
    """Bytes as a ``%.2f`` kilobyte string (half-even), ``-`` for other units."""
    kb = F.bround(_c(value).cast("double") / F.lit(1024.0), 2)
    return F.when(_c(unit) == F.lit("bytes"), F.format_string("%.2f", kb)).otherwise(F.lit("-"))


def unit_word(unit: float) -> str:
    return {1e9: "billion", 1e6: "million", 1e3: "thousand", 1.0: "units"}.get(float(unit), "scaled")
