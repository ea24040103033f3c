"""Business rules on single rows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import REGION_NAMES

# --- fixed values: a total must lie within these multiples of quantity x price
AMOUNT_FLOOR = Decimal("0.5")
AMOUNT_CEILING = Decimal("2.0")
# ----------------------------------------------------------------------------


def _expected_total() -> Column:
    return F.col("quantity") * F.col("unit_price")


def amount_is_plausible() -> Column:
    """TRUE within the allowed multiples; FALSE otherwise, also on NULL input."""
    expected = _expected_total()
    inside = F.col("total_amount").between(expected * F.lit(AMOUNT_FLOOR), expected * F.lit(AMOUNT_CEILING))
    return F.coalesce(inside, F.lit(False))


# --- fixed values: reasons, in the order in which the first match wins -------
REASON_RULES = [
    ("invalid_quantity", lambda: F.col("quantity") <= 0),
    ("invalid_price", lambda: F.col("unit_price") <= 0),
    ("invalid_amount", lambda: F.col("total_amount") <= 0),
    ("failed_amount_sanity", lambda: ~F.col("is_amount_valid")),
    ("missing_customer", lambda: F.col("customer_id").isNull()),
    ("missing_product", lambda: F.col("product_id").isNull()),
]
# ----------------------------------------------------------------------------


def failure_reason() -> Column:
    """The first rule a row breaks, NULL when it breaks none."""
    return F.coalesce(*[F.when(broken(), F.lit(reason)) for reason, broken in REASON_RULES])


def violates_business_rules() -> Column:
    """The batch gate's predicate; NULL input counts as no violation."""
    expected = _expected_total()
    total = F.col("total_amount")
    broken = (
        (F.col("quantity") <= 0)
        | (F.col("unit_price") <= 0)
        | (total <= 0)
        | (total < expected * F.lit(AMOUNT_FLOOR))
        | (total > expected * F.lit(AMOUNT_CEILING))
    )
    return F.coalesce(broken, F.lit(False))


def region_label(code: Column | str, labels: dict[str, str] | None = None) -> Column:
    """Display name of a region code, NULL for an unknown one."""
    code = F.col(code) if isinstance(code, str) else code
    pairs = [F.lit(text) for pair in (labels or REGION_NAMES).items() for text in pair]
    return F.try_element_at(F.create_map(*pairs), code)
