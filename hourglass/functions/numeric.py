"""Numeric cleaning, ratios and banding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's --------------------------
# regime bands on PRC (MW), right-closed: (0,3000] (3000,5000] (5000,10000] (10000,inf)
REGIME_EDGES = (0.0, 3000.0, 5000.0, 10000.0)
REGIME_LABELS = ("Scarcity", "Tight", "Normal", "Surplus")
# wind / solar / west-wind installed-capacity caps (MW)
CAP_WIND_SYSTEM = 45000.0
CAP_SOLAR_SYSTEM = 25000.0
CAP_WIND_WEST = 25000.0
# price tiers ($/MWh): <0, [0,40], (40,100], >100
TIER_LABELS = ("negative", "low", "medium", "high")
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(x) -> Column:
    """pandas treats NaN as missing; Spark compares NaN as the largest value.
    Normalise at every scan."""
    c = _c(x)
    return F.when(~F.isnan(c), c)


def to_numeric(x) -> Column:
    """Bad numerics become NULL instead of failing under ANSI mode."""
    return _c(x).try_cast("double")


def cap_to_null(x, cap: float) -> Column:
    """Values strictly above ``cap`` become NULL; NULL stays NULL."""
    c = _c(x)
    return F.when(~(c > F.lit(cap)), c)


def negative_to_null(x) -> Column:
    c = _c(x)
    return F.when(~(c < 0), c)


def safe_ratio(num, den) -> Column:
    """Ratio that is NULL on a zero denominator (no ANSI failure)."""
    return F.try_divide(_c(num), _c(den))


def log1p_offset(x, offset) -> Column:
    return F.log1p(_c(x) + offset)


def expm1_offset(x, offset) -> Column:
    return F.expm1(_c(x)) - offset


def regime(prc) -> Column:
    """Right-closed PRC bands; <= 0 or NULL gives NULL (``pd.cut`` semantics)."""
    c = _c(prc)
    e0, e1, e2, e3 = REGIME_EDGES
    s, t, n, u = REGIME_LABELS
    return (F.when((c > e0) & (c <= e1), s)
             .when((c > e1) & (c <= e2), t)
             .when((c > e2) & (c <= e3), n)
             .when(c > e3, u))


def price_tier(price) -> Column:
    c = _c(price)
    neg, low, med, high = TIER_LABELS
    return (F.when(c < 0, neg)
             .when((c >= 0) & (c <= 40), low)
             .when((c > 40) & (c <= 100), med)
             .when(c > 100, high))


def coalesce_total(zones: list, total) -> Column:
    """Sum of the zones when every zone is present, else the published total."""
    s = None
    for z in zones:
        s = _c(z) if s is None else s + _c(z)
    return F.coalesce(s, _c(total))
