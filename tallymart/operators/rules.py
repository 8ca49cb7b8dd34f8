"""Quality rules.

A rule is the name of a BOOLEAN column and the SQL predicate that fills it.  The
column is added beside the data; no row is dropped.  Predicates are SQL text, so
a whole rule set is one projection and can be read, listed and stored as data.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str


def quoted(column: str) -> str:
    """A column name as SQL identifier, whatever characters it has."""
    return "`" + column.replace("`", "``") + "`"


def literal(value) -> str:
    """A Python string or number as SQL literal."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def _listed(domain: Iterable) -> str:
    return ", ".join(literal(value) for value in domain)


def missing(column: str) -> str:
    return f"{column} IS NULL"


def missing_or_blank(column: str) -> str:
    return f"({column} IS NULL OR {column} = '')"


def in_domain(column: str, domain: Iterable) -> str:
    """Positive flag; a NULL value is not in the domain."""
    return f"coalesce({column} IN ({_listed(domain)}), false)"


def not_in_domain(column: str, domain: Iterable) -> str:
    return f"({column} IS NOT NULL AND {column} NOT IN ({_listed(domain)}))"


def out_of_range(column: str, low, high) -> str:
    return f"({column} IS NOT NULL AND {column} NOT BETWEEN {literal(low)} AND {literal(high)})"


def negative(column: str) -> str:
    return f"({column} IS NOT NULL AND {column} < 0)"


def non_positive(column: str) -> str:
    return f"({column} IS NOT NULL AND {column} <= 0)"


def malformed(column: str, pattern: str) -> str:
    return f"({column} IS NOT NULL AND NOT {column} RLIKE {literal(pattern)})"


def unparsable(raw: str, parsed: str) -> str:
    return f"({raw} IS NOT NULL AND {parsed} IS NULL)"


def before(earlier: str, later: str) -> str:
    """TRUE where ``earlier`` precedes ``later``; FALSE when one of them is unknown."""
    return f"coalesce({earlier} < {later}, false)"


def missing_when(column: str, status_column: str, status: str) -> str:
    """Three-valued: NULL when the status is unknown and the value is absent."""
    return f"({status_column} = {literal(status)} AND {column} IS NULL)"


def any_of(predicates: Iterable[str]) -> str:
    return "(" + " OR ".join(predicates) + ")"


def apply_rules(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Add every flag in one projection."""
    return df.selectExpr("*", *[f"{rule.predicate} AS {quoted(rule.name)}" for rule in rules])


def count_flags(flags: Iterable[str]) -> list[Column]:
    """One counter per flag column; a NULL flag is not counted."""
    return [F.expr(f"count_if({quoted(flag)}) AS {quoted(flag)}") for flag in flags]


def summarise(df: DataFrame, flags: Iterable[str], extra: Iterable[Column] = ()) -> DataFrame:
    """All flag counts on one row, from a single pass with map-side partial counts."""
    return df.agg(*extra, *count_flags(flags))


def flagged_rows(df: DataFrame, flags: Iterable[str]) -> DataFrame:
    """Investigation view: rows for which at least one flag is set."""
    return df.filter(any_of(map(quoted, flags)))
