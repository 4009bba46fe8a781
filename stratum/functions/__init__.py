"""Column-expression helpers (JVM-side, codegen friendly)."""

from .buckets import (age_bucket, bucket, company_tier, grit_index, grit_level,
                      rank_tier)
from .numeric import coerce_numeric, kb_text, parse_money, round_half, safe_pct, unit_word
from .text import (ascii_fold, base_name, find_column, first_number, missing_to_null,
                   name_key, normalize_missing, slug, split_list, strip_ws, year_in_name)

__all__ = [
    "age_bucket", "bucket", "company_tier", "grit_index", "grit_level", "rank_tier",
    "coerce_numeric", "kb_text", "parse_money", "round_half", "safe_pct", "unit_word",
    "ascii_fold", "base_name", "find_column", "first_number", "missing_to_null",
    "name_key", "normalize_missing", "slug", "split_list", "strip_ws", "year_in_name",
]
