"""Data-quality rules (V-series).

A rule is either a row predicate (``count_if``) or a uniqueness rule on a key
(rows minus distinct keys); all rules of a table are evaluated in ONE
aggregation pass.  ``validate`` returns a report
``(table_name, rule, severity, violations)`` as a DataFrame; nothing stops at
the first failure.  ``enforce`` collects that report (one row per rule) and
raises once, listing every fatal rule that has violations.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FATAL, WARNING, REPORT = "fatal", "warning", "report"

REPORT_COLUMNS = ["table_name", "rule", "severity", "violations"]


class DataQualityError(Exception):
    """Raised by ``enforce`` when a fatal rule has violations."""


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str = FATAL
    violation: Column | None = None  # row predicate: true for a violating row
    unique: tuple[str, ...] | None = None  # key that must not repeat

    @staticmethod
    def not_null(col: str, severity: str = FATAL, name: str | None = None) -> Rule:
        return Rule(name or f"{col}_not_null", severity, violation=F.col(col).isNull())

    @staticmethod
    def unique_key(*cols: str, severity: str = FATAL, name: str | None = None) -> Rule:
        return Rule(name or f"{'_'.join(cols)}_unique", severity, unique=tuple(cols))

    @staticmethod
    def row(name: str, violation: Column, severity: str = FATAL) -> Rule:
        return Rule(name, severity, violation=violation)


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _report_rows(table: str, items: Sequence[tuple[str, str, str]]) -> str:
    """One SQL generator expression yielding a report row per ``(rule, severity,
    count column)``; built as text so the whole report row is one expression."""
    structs = ", ".join(
        f"named_struct('table_name', {_sql_text(table)}, 'rule', {_sql_text(name)}, "
        f"'severity', {_sql_text(sev)}, 'violations', CAST(`{col}` AS BIGINT))"
        for name, sev, col in items
    )
    return f"inline(array({structs}))"


def validate(df: DataFrame, table: str, rules: Iterable[Rule]) -> DataFrame:
    """One report row per rule.  The row rules of a table are one aggregation without a
    shuffle of rows.  A uniqueness rule is an aggregation of its own over its key columns alone: rows less
    groups, where NULLs are equal, so NULL keys repeat like any other value (the duplicated-rows
    semantics); equal keys collapse map-side, so a hot key moves one row per task."""
    rules = list(rules)
    parts = []
    if per_row := [r for r in rules if r.violation is not None]:
        counts = df.agg(*[F.count_if(r.violation).alias(f"_v{i}") for i, r in enumerate(per_row)])
        parts.append(counts.selectExpr(_report_rows(table, [(r.name, r.severity, f"_v{i}") for i, r in enumerate(per_row)])))
    for r in rules:
        if r.violation is None:
            groups = df.groupBy(*r.unique).agg(F.count(F.lit(1)).alias("_n"))
            parts.append(value_report(table, r.name, r.severity, groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n")), "n"))
    return report_union(parts)


def report_union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_report(table: str, name: str, severity: str, counted: DataFrame) -> DataFrame:
    """A report row whose violation count is the number of rows of ``counted``."""
    return counted.agg(F.count(F.lit(1)).alias("_n")).selectExpr(_report_rows(table, [(name, severity, "_n")]))


def values_report(table: str, items: Sequence[tuple[str, str, str]], one_row: DataFrame) -> DataFrame:
    """A report row per ``(rule, severity, column)`` of a one-row DataFrame."""
    return one_row.selectExpr(_report_rows(table, items))


def value_report(table: str, name: str, severity: str, one_row: DataFrame, value_col: str) -> DataFrame:
    """A report row whose violation count is ``value_col`` of a one-row DataFrame."""
    return one_row.selectExpr(_report_rows(table, [(name, severity, value_col)]))


def unmatched_row_count(df: DataFrame, parent_keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``parent_keys`` (NULL keys included,
    as ``LEFT JOIN ... WHERE parent.key IS NULL`` counts them), as one row ``n``.

    Counted per key first: the partial aggregate collapses a hot key map-side,
    so the anti join moves one row per key and task, never every fact row."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    missing = per_key.join(parent_keys.select(key), key, "left_anti")
    return missing.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("n"))


def enforce(report: DataFrame) -> list[T.Row]:
    """Collect the (small) report; raise if any fatal rule has violations."""
    rows = report.collect()
    failed = [r for r in rows if r["severity"] == FATAL and (r["violations"] or 0) > 0]
    if failed:
        listing = "; ".join(f"{r['table_name']}.{r['rule']}={r['violations']}" for r in failed)
        raise DataQualityError(f"fatal data-quality violations: {listing}")
    return rows


# --- rule sets of the staged tables (V1-V13) ---------------------------------------------


def listing_rules() -> list[Rule]:
    return [
        Rule.unique_key("listing_id"),  # V1
        Rule.not_null("listing_id"),  # V2
        Rule.row("price_not_negative", F.col("price") < 0),  # V3
        Rule.row("accommodates_positive", F.col("accommodates") <= 0),  # V4
        Rule.row("bedrooms_not_negative", F.col("bedrooms") < 0),  # V4
        Rule.row("min_nights_le_max_nights", F.col("minimum_nights") > F.col("maximum_nights"), WARNING),  # V6
        Rule.row("rating_between_1_and_5", (F.col("review_scores_rating") < 1) | (F.col("review_scores_rating") > 5)),
    ]


def review_rules() -> list[Rule]:
    return [
        Rule.unique_key("review_id"),  # V8
        Rule.not_null("listing_id"),  # V9
        Rule.not_null("date"),  # V5
    ]


def neighbourhood_rules() -> list[Rule]:
    return [
        Rule.not_null("neighbourhood"),  # V10
        Rule.not_null("neighbourhood_group"),  # V10
        Rule.unique_key("neighbourhood"),  # V11
    ]


def calendar_rules() -> list[Rule]:
    return [
        Rule.not_null("listing_id"),  # V9
        Rule.not_null("date"),  # V5
        Rule.not_null("available"),  # V12
        Rule.unique_key("listing_id", "date"),  # V13
    ]


# --- warehouse constraints (V16) -------------------------------------------------------------


def constraint_rules(schema: T.StructType, unique_keys: Sequence[Sequence[str]], widths: dict[str, int]) -> list[Rule]:
    """NOT NULL for every non-nullable field, UNIQUE keys, and NVARCHAR widths."""
    rules = [Rule.not_null(f.name) for f in schema.fields if not f.nullable]
    rules += [Rule.unique_key(*k) for k in unique_keys]
    rules += [Rule.row(f"{c}_width_le_{n}", F.length(c) > n) for c, n in widths.items()]
    return rules
