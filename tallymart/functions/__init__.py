"""Column functions: tolerant parsing, casting and money arithmetic."""

from tallymart.functions.money import average_order_value, local_revenue, usd_revenue
from tallymart.functions.parsing import (
    all_present,
    parse_date,
    parse_timestamp,
    to_money,
    to_whole,
)

__all__ = [
    "all_present",
    "average_order_value",
    "local_revenue",
    "parse_date",
    "parse_timestamp",
    "to_money",
    "to_whole",
    "usd_revenue",
]
