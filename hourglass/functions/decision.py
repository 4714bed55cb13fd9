"""Dispatch rules as native CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's --------------------------
SCARCITY_MW = 3000.0
ACTION_CURTAIL = "CURTAIL — emergency, shut down all flexible load"
ACTION_REDUCE_BOTH = "REDUCE — PRC tight + price spike, lower non-critical load"
ACTION_REDUCE_PRC = "REDUCE — PRC tight, lower non-critical load"
ACTION_REDUCE_PRICE = "REDUCE — price spike, lower non-critical load"
ACTION_OPERATE = "OPERATE — standard operations"
RISK_SCARCITY = "PRC scarcity expected"
RISK_TIGHT = "PRC tight expected"
RISK_DAM_PREFIX = "DAM high ($"
RISK_RT_PREFIX = "RT may exceed $"
ADVISORY_ELEVATED_PREFIX = "ELEVATED RISK — "
ADVISORY_ELEVATED_SUFFIX = ". Pre-position flexible load."
ADVISORY_LOW = "LOW RISK — standard scheduling"
HIGH_PRICE = 100.0
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dispatch_action(pred_prc, pred_price, tight_threshold: float,
                    price_threshold: float | None = None) -> Column:
    """The more aggressive of the PRC and price signals.  NULL comparisons
    are false, so a missing score never triggers an action."""
    prc = _c(pred_prc)
    prc_reduce = F.coalesce(prc < F.lit(tight_threshold), F.lit(False))
    if price_threshold is None:
        price_reduce = F.lit(False)
    else:
        price_reduce = F.coalesce(_c(pred_price) > F.lit(price_threshold), F.lit(False))
    return (F.when(F.coalesce(prc < F.lit(SCARCITY_MW), F.lit(False)), ACTION_CURTAIL)
             .when(prc_reduce & price_reduce, ACTION_REDUCE_BOTH)
             .when(prc_reduce, ACTION_REDUCE_PRC)
             .when(price_reduce, ACTION_REDUCE_PRICE)
             .otherwise(ACTION_OPERATE))


def format_dollars(x) -> Column:
    """``'%.0f'`` with round-half-even, as Python formats it."""
    return F.format_string("%d", F.bround(_c(x), 0).cast("long"))


def advisory_24h(pred_prc, pred_rt_24h, dam_price, tight_threshold: float) -> Column:
    prc, rt, dam = _c(pred_prc), _c(pred_rt_24h), _c(dam_price)
    prc_risk = (F.when(prc < F.lit(SCARCITY_MW), RISK_SCARCITY)
                 .when(prc < F.lit(tight_threshold), RISK_TIGHT))
    dam_risk = F.when(dam > F.lit(HIGH_PRICE),
                      F.concat(F.lit(RISK_DAM_PREFIX), format_dollars(dam), F.lit(")")))
    rt_risk = F.when(rt > F.lit(HIGH_PRICE), F.concat(F.lit(RISK_RT_PREFIX), format_dollars(rt)))
    risks = F.concat_ws(", ", prc_risk, dam_risk, rt_risk)
    return (F.when(risks != "", F.concat(F.lit(ADVISORY_ELEVATED_PREFIX), risks,
                                         F.lit(ADVISORY_ELEVATED_SUFFIX)))
             .otherwise(ADVISORY_LOW))


def threshold_override(p_target, base_pred, threshold: float, target_label: str = "Scarcity") -> Column:
    """Predict ``target_label`` when its probability reaches ``threshold``,
    otherwise keep the argmax class."""
    return F.when(_c(p_target) >= F.lit(threshold), F.lit(target_label)).otherwise(_c(base_pred))
