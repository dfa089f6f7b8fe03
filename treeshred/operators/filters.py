"""Ordered allow/deny name filters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from ..functions import regex as R


@dataclass
class FilterRules:
    """Rule lists in order; each rule is a dict with action, tableName and, for columns, columnName."""

    tables: list[dict] = field(default_factory=list)
    columns: list[dict] = field(default_factory=list)

    def __add__(self, other: "FilterRules") -> "FilterRules":
        return FilterRules(self.tables + other.tables, self.columns + other.columns)


def _last_match(tests: list[tuple[str, Column]]) -> Column:
    """Keep unless the last rule that matches is a deny rule."""
    out = F.lit(True)
    for action, test in tests:
        out = F.when(test, F.lit(action == "allow")).otherwise(out)
    return out


def keep_table(rules: FilterRules | None, table: Column) -> Column:
    """Does an escaped table name survive?"""
    return _last_match([(r["action"], R.matches(r["tableName"], table)) for r in (rules.tables if rules else [])])


def keep_column(rules: FilterRules | None, table: Column, column: Column) -> Column:
    return _last_match([(r["action"], R.matches(r["tableName"], table) & R.matches(r["columnName"], column))
                        for r in (rules.columns if rules else [])])
