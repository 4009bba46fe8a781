"""CASE-style bucketing expressions and the label sets they use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's --------------------------
TIER_TOP = "Top Tier Elite (Top 100)"
TIER_MID = "Mid Tier (101-500)"
TIER_NON_TOP = "Non-Top Tier (>500)"
TIER_UNRANKED = "Unranked Higher Ed"
TIER_UNKNOWN = "Unknown Education"
DEGREE_UNKNOWN = "Unknown"
# company age buckets: upper bound (inclusive) -> label, then the rest
AGE_BUCKETS = ((5, "0-5 Years"), (10, "6-10 Years"), (20, "11-20 Years"))
AGE_REST = "20+ Years"
# grit levels: upper bound (exclusive) -> label, then the rest
GRIT_LEVELS = ((10, "Low Grit"), (25, "Medium Grit"))
GRIT_REST = "High Grit"
# grit weight by tier prefix
GRIT_WEIGHTS = (("Unranked%", 2.0), ("Non-Top%", 1.5))
GRIT_DEFAULT_WEIGHT = 1.0
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def bucket(col, bounds, rest: str, inclusive: bool = True) -> Column:
    """``CASE WHEN x <= b1 THEN l1 ... ELSE rest``; a null falls to ``rest``."""
    x = _c(col)
    out = None
    for bound, label in bounds:
        cond = (x <= F.lit(bound)) if inclusive else (x < F.lit(bound))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(rest))


def age_bucket(col) -> Column:
    return bucket(col, AGE_BUCKETS, AGE_REST, inclusive=True)


def grit_level(col) -> Column:
    return bucket(col, GRIT_LEVELS, GRIT_REST, inclusive=False)


def rank_tier(rank) -> Column:
    """Tier from a numeric rank: null -> unranked, <=100, <=500, else."""
    r = _c(rank)
    return (F.when(r.isNull(), F.lit(TIER_UNRANKED))
            .when(r <= 100, F.lit(TIER_TOP))
            .when(r <= 500, F.lit(TIER_MID))
            .otherwise(F.lit(TIER_NON_TOP)))


def company_tier(best_rank, unranked_count) -> Column:
    """Company tier from its best founder rank, then unranked founders."""
    r, u = _c(best_rank), _c(unranked_count)
    return (F.when(r <= 100, F.lit(TIER_TOP))
            .when(r <= 500, F.lit(TIER_MID))
            .when(r > 500, F.lit(TIER_NON_TOP))
            .when(u > 0, F.lit(TIER_UNRANKED))
            .otherwise(F.lit(TIER_UNKNOWN)))


def grit_index(age, tier) -> Column:
    """Company age weighted by the founder's education tier (double)."""
    t = _c(tier)
    weight = None
    for pattern, w in GRIT_WEIGHTS:
        cond = t.like(pattern)
        weight = F.when(cond, F.lit(w)) if weight is None else weight.when(cond, F.lit(w))
    weight = weight.otherwise(F.lit(GRIT_DEFAULT_WEIGHT))
    return _c(age).cast("double") * weight
