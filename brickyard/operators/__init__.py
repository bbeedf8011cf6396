"""DataFrame → DataFrame operators."""
from .cells import cell_stats, median_by
from .cohort import premium
from .dimension import (
    broadcast_checked, counts_by_key, coverage, dimension_hygiene, enrich_join, fingerprint,
    strategy_parity,
)
from .profile import headline, skew_profile
from .trend import growth, latest_growth, rolling_mean

__all__ = [
    "broadcast_checked", "cell_stats", "counts_by_key", "coverage", "dimension_hygiene", "enrich_join",
    "fingerprint", "growth", "headline", "latest_growth", "median_by",
    "premium", "rolling_mean", "skew_profile", "strategy_parity",
]
