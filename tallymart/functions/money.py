"""Revenue arithmetic.

The types follow from the inputs: int x decimal(12,2) is an exact decimal(23,2); times a double
rate it is a double, times a decimal(10,6) rate an exact decimal(34,8).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_revenue(quantity: Column, price: Column) -> Column:
    return quantity * price


def usd_revenue(revenue_local: Column, rate: Column) -> Column:
    return revenue_local * rate


def average_order_value(total_usd: Column, lines: Column) -> Column:
    """USD per line that carries an order id; NULL where there is none."""
    return F.try_divide(total_usd.cast("double"), lines)
