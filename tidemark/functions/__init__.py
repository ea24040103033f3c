"""Column expressions shared by the operators."""

from tidemark.functions.dates import (
    batch_id,
    batch_window,
    batch_window_columns,
    date_spine,
    epoch_millis,
    from_epoch_millis,
    wire_timestamp,
)
from tidemark.functions.keys import surrogate_key, version_key
from tidemark.functions.money import cents_to_dollars, exact_avg, percent_change, safe_add
from tidemark.functions.rules import (
    REASON_RULES,
    amount_is_plausible,
    failure_reason,
    region_label,
    violates_business_rules,
)

__all__ = [
    "REASON_RULES",
    "amount_is_plausible",
    "batch_id",
    "batch_window",
    "batch_window_columns",
    "cents_to_dollars",
    "date_spine",
    "epoch_millis",
    "exact_avg",
    "failure_reason",
    "from_epoch_millis",
    "percent_change",
    "region_label",
    "safe_add",
    "surrogate_key",
    "version_key",
    "violates_business_rules",
    "wire_timestamp",
]
