"""Column lists of the inputs; types are declared in ``fixed_values`` and applied by cast."""

from __future__ import annotations

from tallymart.fixed_values import ABSENT_COLUMNS_MESSAGE, EMPTY_LIST_MESSAGE

SALES_COLUMNS = (
    "ORDER_ID",
    "CUSTOMER_ID",
    "PRODUCT_ID",
    "QUANTITY",
    "PRICE",
    "ORDER_TIMESTAMP",
    "COUNTRY",
)
PRODUCT_COLUMNS = ("PRODUCT_ID", "PRODUCT_NAME", "CATEGORY")
RATE_COLUMNS = ("DATE", "COUNTRY", "CURRENCY", "EXCHANGE_RATE_TO_USD")


def require_columns(present: list[str], wanted: tuple[str, ...] | list[str]) -> None:
    """Raise ValueError naming the wanted columns that are not there (case-sensitive)."""
    if not wanted:
        raise ValueError(EMPTY_LIST_MESSAGE)
    absent = [name for name in wanted if name not in present]
    if absent:
        raise ValueError(ABSENT_COLUMNS_MESSAGE.format(absent=absent))
