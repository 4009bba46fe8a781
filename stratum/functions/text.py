"""Text cleaning expressions (all JVM-side Column expressions, no UDFs)."""

from __future__ import annotations

import functools
import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values that must equal the reference's --------------------------
# Missing-value markers, matched after trimming.
MISSING_MARKERS = ("NA", "N/A", "NULL", "null", "")
# Institution alias map applied after name normalisation.
UNIVERSITY_ALIAS = {
    "royal institute of technology": "kth royal institute of technology",
}
# Default founder for a company without a usable founder list.
UNKNOWN_FOUNDER = "Unknown Founder"
# ---------------------------------------------------------------------------

_WS_EDGES = r"(?U)^\s+|\s+$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Remove leading and trailing whitespace of any kind (not only spaces)."""
    return F.regexp_replace(_c(col), _WS_EDGES, "")


def missing_to_null(col, markers=MISSING_MARKERS) -> Column:
    """Trim, then map the missing-value markers to null."""
    t = strip_ws(col)
    return F.when(~t.isin(*markers), t)


def normalize_missing(df: DataFrame, markers=MISSING_MARKERS,
                      columns: list[str] | None = None) -> DataFrame:
    """Apply :func:`missing_to_null` to every string column (or ``columns``)."""
    names = columns or [f.name for f in df.schema.fields
                        if isinstance(f.dataType, T.StringType)]
    # strip in one projection, test markers in the next: each value is
    # stripped once (a projection is not collapsed into its consumer when
    # that would evaluate a costly expression twice)
    stripped = df.withColumns({n: strip_ws(n) for n in names})
    return stripped.withColumns({n: F.when(~F.col(n).isin(*markers), F.col(n)) for n in names})


@functools.lru_cache(maxsize=1)
def _fold_tables():
    """Per-character tables equal to NFKD followed by dropping non-ASCII.

    NFKD then ASCII-dropping works character by character, so it is a fixed
    mapping from each code point to an ASCII string, generated here from the
    Unicode database rather than written out.
    """
    single_src, single_dst, multi = [], [], {}
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        folded = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if len(folded) == 1:
            single_src.append(ch)
            single_dst.append(folded)
        elif len(folded) > 1:
            multi[ch] = folded
    return "".join(single_src), "".join(single_dst), multi


def ascii_fold(col) -> Column:
    """NFKD decomposition with every non-ASCII result dropped.

    One ``translate`` handles the characters that fold to one ASCII char;
    the few that fold to several (ligatures, fractions, ...) are mapped
    character by character only in values that contain one; everything
    left that is not ASCII is removed.
    """
    src, dst, multi = _fold_tables()
    x = _c(col)
    # one string literal, folded once into a map constant
    packed = "\x01".join(f"{k}\x02{v}" for k, v in sorted(multi.items()))
    mapping = F.str_to_map(F.lit(packed), F.lit("\x01"), F.lit("\x02"))
    expanded = F.array_join(
        F.transform(F.split(x, ""), lambda ch: F.coalesce(F.element_at(mapping, ch), ch)), "")
    # guard: does the value hold any multi-character fold?  (translate is one
    # hash lookup per character; a regex class this large is not)
    multi_src = "".join(sorted(multi))
    has_multi = F.length(F.translate(x, multi_src, "")) < F.length(x)
    x = F.when(has_multi, expanded).otherwise(x)
    x = F.translate(x, src, dst)
    return F.regexp_replace(x, r"[^\x00-\x7F]", "")


def apply_alias(col, aliases: dict) -> Column:
    """Replace a value equal to an alias key by its target.

    An anchored whole-value ``regexp_replace`` per entry, so the (costly)
    input expression is referenced once and evaluated once.
    """
    x = _c(col)
    for k, v in aliases.items():
        target = v.replace("\\", "\\\\").replace("$", "\\$")
        x = F.regexp_replace(x, "^" + re.escape(k) + "$", target)
    return x


def name_key(col, aliases: dict | None = None, empty_as_null: bool = False) -> Column:
    """Matching key for institution names.

    lower-case, fold to ASCII, drop parenthesised parts, ``&`` to ``and``,
    every other non-alphanumeric run to one space, trim, then the alias map.
    """
    # Edge whitespace needs no separate strip and space runs no separate
    # squeeze: every non-alphanumeric run (whitespace included) becomes one
    # space below and the ends are trimmed, so both steps are implied.
    x = F.lower(_c(col))
    x = ascii_fold(x)
    x = F.regexp_replace(x, r"\([^)]*\)", "")
    x = F.replace(x, F.lit("&"), F.lit(" and "))
    x = F.regexp_replace(x, r"[^a-z0-9]+", " ")
    x = F.trim(x)
    x = apply_alias(x, UNIVERSITY_ALIAS if aliases is None else aliases)
    if empty_as_null:
        x = F.when(x != "", x)
    return x


def slug(col) -> Column:
    """``lower(replace(x, ' ', '_'))``."""
    return F.lower(F.replace(_c(col), F.lit(" "), F.lit("_")))


def first_number(col) -> Column:
    """First run of ASCII digits as a double; null when there is none."""
    return F.regexp_substr(_c(col), F.lit("[0-9]+")).cast("double")


def year_in_name(col, default: int = 0) -> Column:
    """First ``20dd`` in a name as an int, else ``default``."""
    return F.coalesce(F.regexp_substr(_c(col), F.lit("20[0-9]{2}")).cast("int"), F.lit(default))


def split_list(col, sep: str = ",", default: str | None = UNKNOWN_FOUNDER) -> Column:
    """Split a delimited list, trim items, drop empty ones.

    An empty or null list becomes ``[default]`` (or an empty array when
    ``default`` is None).
    """
    items = F.filter(F.transform(F.split(_c(col), sep), lambda y: strip_ws(y)),
                     lambda y: y != "")
    if default is None:
        return F.coalesce(items, F.array().cast("array<string>"))
    return F.when(items.isNull() | (F.size(items) == 0), F.array(F.lit(default))).otherwise(items)


def base_name(col) -> Column:
    """Last path component."""
    return F.element_at(F.split(_c(col), "/"), -1)


def find_column(df: DataFrame, *needles: str) -> str:
    """First column whose lower-cased name contains any needle (metadata only)."""
    for name in df.columns:
        low = name.lower()
        if any(n in low for n in needles):
            return name
    raise KeyError(f"no column matching {needles} in {df.columns}")
