"""Column-level building blocks: fixed codes, cleaning rules, derived features."""
from .features import alpha_prefix, decode, enrich, flag, pct_change, share_pct
from .rules import Rule, apply_rules, audit, price_paid_rules

__all__ = [
    "Rule", "alpha_prefix", "apply_rules", "audit", "decode", "enrich", "flag",
    "pct_change", "price_paid_rules", "share_pct",
]
