"""Data-quality rules, profiles and the quality report.

Rules are plain data.  A whole list of them, with null counts for every column, compiles into one aggregation, so a
table is read once however many rules there are.  The one resulting row carries the rule results as an array.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilayer.operators.aggregate import take_rows
from trilayer.operators.quantiles import numeric_columns, summarised, survey


@dataclass(frozen=True)
class Rule:
    """One check.  `kind` is row_count, not_null, between or in_set."""

    kind: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    mostly: float = 1.0
    allowed: tuple = ()

    @property
    def name(self) -> str:
        return RULE_NAMES[self.kind]


# The names rules carry in reports.
RULE_NAMES = {
    "row_count": "expect_table_row_count_to_be_between",
    "not_null": "expect_column_values_to_not_be_null",
    "between": "expect_column_values_to_be_between",
    "in_set": "expect_column_distinct_values_to_be_in_set",
}


def row_count(low: int | None = None, high: int | None = None) -> Rule:
    return Rule("row_count", low=low, high=high)


def not_null(column: str, mostly: float = 1.0) -> Rule:
    """At least the share `mostly` of all rows has a value."""
    return Rule("not_null", column, mostly=mostly)


def between(column: str, low: float | None = None, high: float | None = None, mostly: float = 1.0) -> Rule:
    """Values lie within the bounds, both included; nulls are not looked at."""
    return Rule("between", column, low, high, mostly)


def in_set(column: str, *allowed) -> Rule:
    """No value other than the allowed ones occurs; nulls are not looked at."""
    return Rule("in_set", column, allowed=allowed)


# The rules of the hourly weather table.
WEATHER_RULES = [
    row_count(low=1),
    not_null("ts"),
    not_null("location_name"),
    not_null("temperature_c", mostly=0.95),
    between("temperature_c", -50, 60),
    between("relative_humidity_pct", 0, 100),
    between("precipitation_mm", 0),
    between("rain_mm", 0),
    between("snowfall_cm", 0),
    between("cloud_cover_pct", 0, 100),
    between("wind_speed_ms", 0),
    between("wind_gusts_ms", 0),
    in_set("is_raining", True, False),
    in_set("is_snowing", True, False),
]


def _missing(df: DataFrame, column: str) -> str:
    """SQL test for null; a NaN counts as one."""
    test = f"`{column}` is null"
    floating = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    return f"({test} or isnan(`{column}`))" if floating else test


def _literal(value) -> str:
    if isinstance(value, str):
        text = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{text}'"
    return str(value)


def _beyond(value: str, low: float | None, high: float | None) -> str:
    tests = [f"{value} {sign} {bound}" for sign, bound in (("<", low), (">", high)) if bound is not None]
    return " or ".join(tests) or "false"


def _broken(df: DataFrame, rule: Rule) -> str:
    """SQL test for a row that breaks a rule on a column."""
    if rule.kind == "not_null":
        return _missing(df, rule.column)
    if rule.kind == "between":
        return f"not {_missing(df, rule.column)} and ({_beyond(f'`{rule.column}`', rule.low, rule.high)})"
    return f"`{rule.column}` not in ({', '.join(map(_literal, rule.allowed))})"


def _verdict(rule: Rule, broken: str, missing: str | None) -> str:
    """SQL struct of one result from the counts `rows`, `broken` and `missing`.

    Percentages are over all rows for null checks and over rows with a value else; without any such row a rule holds.
    Counts a rule does not report are null.
    """
    checked = unexpected = percent = None
    if rule.kind == "row_count":
        holds, missing = f"not ({_beyond('rows', rule.low, rule.high)})", None
    elif rule.kind == "in_set":
        holds = f"{broken} = 0"
    else:
        checked = "rows" if rule.kind == "not_null" else f"(rows - {missing})"
        holds = f"{broken} <= {1.0 - rule.mostly!r}D * {checked} + 1e-9D"
        unexpected, percent = broken, f"coalesce(try_divide(100D * {broken}, {checked}), 0D)"
        missing = None if rule.kind == "not_null" else missing
    return (
        f"named_struct('rule', {_literal(rule.name)}, 'column', {_literal(rule.column or 'table')}, 'success', {holds}, "
        f"'element_count', rows, 'missing_count', cast({missing or 'null'} as bigint), "
        f"'unexpected_count', cast({unexpected or 'null'} as bigint), "
        f"'unexpected_percent', cast({percent or 'null'} as double))"
    )


def _with_rounded(structs: str, field: str, digits: int) -> Column:
    """An array of structs with one field rounded."""
    return F.transform(structs, lambda s: s.withField(field, F.round(s[field], digits)))


def _counts(df: DataFrame, rules: list[Rule]) -> dict[str, str]:
    """The counts that rules and the null summary are made of, as SQL aggregates by name."""
    unknown = sorted({r.column for r in rules if r.column is not None} - set(df.columns))
    if unknown:
        raise ValueError(f"rules on unknown columns: {unknown}")
    counts = {"rows": "count(1)"} | {f"null{i}": f"count_if({_missing(df, c)})" for i, c in enumerate(df.columns)}
    return counts | {f"broken{i}": f"count_if({_broken(df, r)})" for i, r in enumerate(rules) if r.kind != "row_count"}


def _profiled(row: DataFrame, columns: list[str], rules: list[Rule]) -> DataFrame:
    """The profile from one row of counts."""
    null_of = {c: f"null{i}" for i, c in enumerate(columns)}
    results = [_verdict(rule, f"broken{i}", null_of.get(rule.column)) for i, rule in enumerate(rules)]
    nulls = [
        f"named_struct('column', {_literal(c)}, 'null_count', {name}, "
        f"'null_percent', try_divide(100D * {name}, rows))"
        for c, name in null_of.items()
    ]
    found = row.selectExpr("rows", f"array({', '.join(results)}) as results", f"array({', '.join(nulls)}) as nulls")
    return found.select(
        "rows",
        (_with_rounded("results", "unexpected_percent", 6) if rules else F.col("results")).alias("results"),
        _with_rounded("nulls", "null_percent", 2).alias("nulls"),
    )


def profile(df: DataFrame, rules: Iterable[Rule] = ()) -> DataFrame:
    """One row: `rows`, `results` (one struct per rule) and `nulls` (one struct per column)."""
    rules = list(rules)
    row = df.agg(*(F.expr(text).alias(name) for name, text in _counts(df, rules).items()))
    return _profiled(row, df.columns, rules)


def run_rules(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """One row per rule."""
    return profile(df, rules).select(F.inline("results"))


def rule_statistics(results: DataFrame) -> DataFrame:
    """Whether all rules hold, and how many were evaluated, held and failed."""
    return results.agg(
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
        F.count(F.lit(1)).alias("evaluated_expectations"),
        F.count_if(F.col("success")).alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("unsuccessful_expectations"),
    )


def rule_failures(results: DataFrame) -> DataFrame:
    """Rules that do not hold.  Counts a rule does not report are null."""
    return results.filter(~F.col("success")).select("rule", "column", "unexpected_count", "unexpected_percent")


def null_summary(df: DataFrame) -> DataFrame:
    """Nulls per column, most first; equal counts by name."""
    return profile(df).select(F.inline("nulls")).orderBy(F.desc("null_count"), F.asc("column"))


def quality_report(
    df: DataFrame,
    rules: Iterable[Rule],
    name: str,
    source: str,
    generated_at: datetime,
    first_rows_by: list[str],
    top: int,
    first: int,
) -> DataFrame:
    """The whole report as one row of nested columns, ready for a JSON sink.

    `df` is read three times: for rules, nulls and the numeric survey, for the quartiles, and for the first rows, a top-n.
    Rows that are equal in `first_rows_by` follow each other by their whole text, so the same ones are shown each time.
    `top` and `first` bound the listed nulls and rows.  Everything that meets in the row has a size set by the number of columns and rules.
    """
    rules = list(rules)
    counts = _counts(df, rules)
    counted, facts = survey(df, numeric_columns(df), list(counts.values()))
    row = df.sparkSession.createDataFrame([tuple(counted)], ", ".join(f"{name} bigint" for name in counts))
    results, nulls = F.col("results"), F.col("nulls")
    failed = F.filter(results, lambda r: ~r["success"])
    # Structs sort by their first field first: negate the count for descending, then the name.
    ranked = F.array_sort(
        F.transform(nulls, lambda n: F.struct((-n["null_count"]).alias("o"), n["column"].alias("c"), n.alias("n")))
    )
    head = _profiled(row, df.columns, rules).select(
        F.lit(name).alias("report_name"),
        F.lit(source).alias("source"),
        F.lit(generated_at.isoformat()).alias("generated_at_utc"),
        F.col("rows").alias("rows_checked"),
        (F.size(failed) == 0).alias("success"),
        F.struct(
            F.size(results).cast("long").alias("evaluated_expectations"),
            (F.size(results) - F.size(failed)).cast("long").alias("successful_expectations"),
            F.size(failed).cast("long").alias("unsuccessful_expectations"),
        ).alias("statistics"),
        F.transform(
            failed,
            lambda r: F.struct(
                r["rule"].alias("expectation"),
                r["column"].alias("column"),
                r["unexpected_count"].alias("unexpected_count"),
                r["unexpected_percent"].alias("unexpected_percent"),
            ),
        ).alias("failures"),
        F.transform(F.slice(ranked, 1, top), lambda x: x["n"]).alias("null_summary"),
    )
    numbers = summarised(df, facts)
    numeric = numbers.agg(F.array_sort(F.collect_list(F.struct(*numbers.columns))).alias("numeric_summary"))
    text = F.struct(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns)).alias("row")
    shown = take_rows(df.select(*(F.col(f"`{c}`").alias(f"_by{i}") for i, c in enumerate(first_rows_by)), text, F.to_json(text).alias("_text")), first, [*(f"_by{i}" for i in range(len(first_rows_by))), "_text"])
    ordered = F.array_sort(F.collect_list(F.struct(*(c for c in shown.columns if c.startswith("_by")), "_text", "row")))
    rows = shown.agg(F.transform(ordered, lambda r: r["row"]).alias("first_rows"))
    parts = head.unionByName(numeric, allowMissingColumns=True).unionByName(rows, allowMissingColumns=True)
    return parts.agg(*(F.first(c, ignorenulls=True).alias(c) for c in parts.columns))
