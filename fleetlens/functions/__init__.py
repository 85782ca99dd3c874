from fleetlens.functions.columns import (  # noqa: F401
    afr_pct,
    capacity_class,
    capacity_sentinel,
    day_of_week_sunday0,
    non_sentinel,
    normalize_model,
    quarter_label,
    round2,
    surrogate_key,
)
