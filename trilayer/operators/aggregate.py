"""Counts, profiles, pivots and correlations."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.functions.dates import hour_bin
from trilayer.functions.numeric import exact_mean, round_columns, safe_corr


def time_profile(df: DataFrame, ts: str) -> DataFrame:
    """Earliest and latest time and the number of rows."""
    return df.agg(
        F.min(ts).alias(f"min_{ts}"),
        F.max(ts).alias(f"max_{ts}"),
        F.count(F.lit(1)).alias("rows"),
    )


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, ascending by key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).orderBy(*keys)


def count_since(df: DataFrame, key: str, ts: str, since: Column) -> DataFrame:
    """Rows per key from `since` on, most frequent first."""
    counts = df.filter(F.col(ts) >= since).groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(key))


def count_per_hour(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(hour_bin(F.col(ts)).alias("hour")).agg(F.count(F.lit(1)).alias("count"))


def take_rows(df: DataFrame, n: int, order_by: list[str] | None = None) -> DataFrame:
    """Any `n` rows, or the first `n` in an order, found by a top-n per task."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def rows_as_text(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """The first `n` rows with all columns as text."""
    first = take_rows(df, n, order_by)
    return first.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns))


def _text(value: str) -> str:
    """A text as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def pivot_mean(df: DataFrame, key: str, category: str, values: list[str], measure: str) -> DataFrame:
    """One row per key and one column per listed category with the mean of `measure`.

    Conditional averages need one exchange on `key`; a pivot on (key, category) would need a second one.  A category
    without rows gives null, an unlisted one is ignored.  Keys that only have unlisted categories stay.
    """
    means = [exact_mean(f"if(`{category}` = {_text(v)}, cast(`{measure}` as double), null)").alias(v) for v in values]
    return df.groupBy(key).agg(*means)


def pair_corrs(df: DataFrame, x: str, others: list[str], digits: int = 6) -> DataFrame:
    """Correlation of `x` with each other column over the rows where both are present, as rows (x, y, pairs, r)."""
    pairs = [F.expr(f"count_if(`{x}` is not null and `{y}` is not null)").alias(f"n{i}") for i, y in enumerate(others)]
    row = df.agg(*pairs, *(safe_corr(x, y).alias(f"r{i}") for i, y in enumerate(others)))
    cells = [f"named_struct('x', '{x}', 'y', '{y}', 'pairs', n{i}, 'r', r{i})" for i, y in enumerate(others)]
    return round_columns(row.selectExpr(f"inline(array({', '.join(cells)}))"), ["r"], digits)


def corr_matrix(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Pairwise correlations as rows (x, y, r).

    All pairs come from one aggregation with mergeable partials, so the input is read once and each task hands on one
    row.  Rounded, since the last bits depend on how rows were spread over tasks.
    """
    pairs = list(combinations_with_replacement(columns, 2))
    row = df.agg(*(safe_corr(x, y).alias(f"r{i}") for i, (x, y) in enumerate(pairs)))
    cells = [
        f"named_struct('x', '{a}', 'y', '{b}', 'r', r{i})"
        for i, (x, y) in enumerate(pairs)
        for a, b in dict.fromkeys([(x, y), (y, x)])
    ]
    return round_columns(row.selectExpr(f"inline(array({', '.join(cells)}))"), ["r"], digits)
