"""Quality rules as data, counted together in one pass.

A rule is a predicate that is true for a violating row. All rules of a gate become ``count_if``
columns of a single global aggregate: each task returns one row of counters, so the gate costs one
scan whatever the number of rules, and nothing grows with the data on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallymart.fixed_values import GATE_ERROR_HEADING, GATE_MAX_AGE_DAYS, GATE_MESSAGES
from tallymart.schemas import require_columns
from tallymart.sources.published import footer_nulls, stored_types

# Types of which a Parquet footer tells all that the null scan asks.
FOOTER_TYPES = ("tinyint", "smallint", "int", "bigint", "boolean", "date", "timestamp", "string")


@dataclass(frozen=True)
class Rule:
    """``kind`` picks the message, ``violated`` is the predicate over one row."""

    kind: str
    column: str
    violated: Column

    def message(self, violations: int) -> str:
        return GATE_MESSAGES[self.kind].format(
            column=self.column, violations=violations, days=GATE_MAX_AGE_DAYS
        )


def moment(as_of: date | datetime | str, type_name: str = "timestamp") -> Column:
    """``as_of`` as a literal of the given time type, read in the session time zone."""
    text = as_of if isinstance(as_of, str) else as_of.isoformat()
    return F.lit(text).cast(type_name)


def missing_rules(columns: Iterable[str]) -> list[Rule]:
    return [Rule("missing", name, F.col(name).isNull()) for name in columns]


def non_positive_rules(columns: Iterable[str]) -> list[Rule]:
    """NULL and NaN are not counted here."""
    return [Rule("non_positive", name, F.col(name) <= 0) for name in columns]


def stale_rule(column: str, now: Column) -> Rule:
    """No time at all, or strictly more than 90 days before ``now``."""
    oldest = now - F.expr(f"INTERVAL {GATE_MAX_AGE_DAYS} DAYS")
    return Rule("stale", column, F.col(column).isNull() | (F.col(column) < oldest))


def future_rule(column: str, now: Column) -> Rule:
    return Rule("future", column, F.col(column) > now)


def rate_rule(column: str) -> Rule:
    return Rule("rate", column, F.col(column).isNull() | (F.col(column) <= 0))


def gate_rules(
    df: DataFrame,
    missing_cols: Sequence[str],
    numeric_cols: Sequence[str],
    date_col: str,
    rate_col: str,
    as_of: date | datetime | str,
) -> list[Rule]:
    """The full rule list, in the order its messages are reported."""
    require_columns(df.columns, [*missing_cols, *numeric_cols, date_col, rate_col])
    now = moment(as_of, dict(df.dtypes)[date_col])
    return [
        *missing_rules(missing_cols),
        *non_positive_rules(numeric_cols),
        stale_rule(date_col, now),
        future_rule(date_col, now),
        rate_rule(rate_col),
    ]


def rule_counters(rules: Sequence[Rule]) -> list[Column]:
    """One counter column per rule, for ``agg`` or ``observe``."""
    return [F.count_if(rule.violated).alias(f"rule_{at}") for at, rule in enumerate(rules)]


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: position, rule, column, violations."""
    entries = [
        F.struct(
            F.lit(at).alias("position"),
            F.lit(rule.kind).alias("rule"),
            F.lit(rule.column).alias("column"),
            F.col(f"rule_{at}").alias("violations"),
        )
        for at, rule in enumerate(rules)
    ]
    return df.agg(*rule_counters(rules)).select(F.inline(F.array(*entries)))


def failures(rules: Sequence[Rule], counters: Row | dict[str, int]) -> list[str]:
    """Messages of the rules whose counter is above zero."""
    counts = [counters[f"rule_{at}"] for at in range(len(rules))]
    return [rule.message(count) for rule, count in zip(rules, counts, strict=True) if count > 0]


def enforce(rules: Sequence[Rule], counters: Row | dict[str, int]) -> None:
    """Raise one ValueError that lists every violated rule."""
    messages = failures(rules, counters)
    if messages:
        raise ValueError("\n".join([GATE_ERROR_HEADING, *messages]))


def validate(
    df: DataFrame,
    missing_cols: Sequence[str],
    numeric_cols: Sequence[str],
    date_col: str,
    rate_col: str,
    as_of: date | datetime | str,
) -> None:
    """Run the whole gate over ``df`` in one job and raise if any rule is violated.

    Works on raw as well as on joined lines, so the gate can also be put before the joins, where
    missing values and times still show.
    """
    rules = gate_rules(df, missing_cols, numeric_cols, date_col, rate_col, as_of)
    enforce(rules, df.agg(*rule_counters(rules)).first())


def null_scan(df: DataFrame) -> DataFrame:
    """One row per column: its name and how many NULL or NaN values it holds."""

    def is_missing(name: str, type_name: str) -> Column:
        empty = F.col(name).isNull()
        return empty | F.isnan(name) if type_name in ("double", "float") else empty

    counts = [F.count_if(is_missing(name, kind)).alias(name) for name, kind in df.dtypes]
    entries = [
        F.struct(F.lit(name).alias("column"), F.col(name).alias("nulls")) for name in df.columns
    ]
    return df.agg(*counts).select(F.inline(F.array(*entries)))


def stored_null_scan(table: DataFrame, path: str) -> DataFrame:
    """``null_scan`` of the whole published table at ``path``, which ``table`` reads.

    NULLs are counted in the footers of its files. Only columns that may hold NaN are read, and
    partition columns, which lie in no file. Where a footer lacks a count, all columns are read.
    """
    stored = stored_types(table) or {}
    counted = [
        name
        for name in table.columns
        if stored.get(name, "") in FOOTER_TYPES or stored.get(name, "").startswith("decimal")
    ]
    nulls = footer_nulls(table, path, counted)
    if not nulls:
        return null_scan(table)
    entries = [
        F.struct(F.lit(name).alias("column"), F.lit(count).cast("long").alias("nulls"))
        for name, count in nulls.items()
    ]
    known = table.sparkSession.range(1).select(F.inline(F.array(*entries)))
    others = [name for name in table.columns if name not in counted]
    return known.unionAll(null_scan(table.select(*others))) if others else known
