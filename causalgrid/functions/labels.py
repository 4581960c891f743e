"""Labels for people: alert levels, reservoir levels, feature classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unavailable MW at which an alert is raised.
CRITICAL_MW, WARNING_MW = 1_000.0, 500.0
# Share of the reservoir at which a level begins.
ADEQUATE_FILL, MODERATE_FILL = 0.60, 0.30

# Beginnings of feature names per class; anything else is calendar or other.
CLASS_PREFIXES = {
    "lags and rolling": (
        "load_mw_lag", "imbalance_mwh_lag", "price_eur_mwh_lag",
        "load_mw_roll", "imbalance_mwh_roll", "price_eur_mwh_roll",
        "imbalance_mwh_diff", "load_mw_diff",
        "imbalance_weekly", "load_mw_cv", "imbalance_mwh_zscore", "price_eur_mwh_dev",
    ),
    "housing": (
        "smahus", "winter_x", "seasonal_temp", "construction_x",
        "peak_tariff_x", "load_mw_yoy", "rate_x_construction",
    ),
    "policy rate": ("riksbank_rate", "riksbank_policy"),
}


def alert_level(outage_mw: Column) -> Column:
    return F.when(outage_mw >= CRITICAL_MW, "CRITICAL").when(outage_mw >= WARNING_MW, "WARNING").otherwise("NORMAL")


def reservoir_level(fill: Column) -> Column:
    return F.when(fill >= ADEQUATE_FILL, "Adequate").when(fill >= MODERATE_FILL, "Moderate").otherwise("Low")


def diverges(net_position: Column, imbalance: Column) -> Column:
    """Contract and physics point in opposite directions."""
    return net_position * imbalance < 0


def feature_class(name: Column) -> Column:
    out = None
    for label, prefixes in CLASS_PREFIXES.items():
        hit = name.rlike("^(" + "|".join(prefixes) + ")")
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise("calendar and other")
