"""Exact numeric summary of whole tables in two scans, without gathering a column in one place.

The first scan takes counts, sums and quantile sketches.  A sketch is off by a known share of the rows, so two of its
quantiles, a little below and above a quartile, are sure to have it between them.  The second scan counts what lies
outside these brackets and hands on what lies inside, equal values as one row; the ranks of these rows are running
counts within a bracket, and each quartile is the value at its rank.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from trilayer.functions.numeric import nan_to_null

QUARTILES = [0.25, 0.5, 0.75]
# Inverse of a sketch's rank error, and number of steps between the quantiles taken from one.
SKETCH_ACCURACY = 2_000
SKETCH_STEPS = 500
# Most sketches that meet in the end.
SKETCH_GROUPS = 256

SUMMARY_SCHEMA = (
    "column string, count bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double"
)

# SQL text: number, mean and sum of squared deviations of all rows from those of the groups, merged one by one.
_MOMENTS = (
    "aggregate(collect_list(if(pos = 0 and n > 0, named_struct('n', cast(n as double), 'm', m, 's', s), null)), "
    "named_struct('n', 0D, 'm', 0D, 's', 0D), (a, g) -> named_struct('n', a.n + g.n, "
    "'m', a.m + (g.m - a.m) * g.n / (a.n + g.n), 's', a.s + g.s + (g.m - a.m) * (g.m - a.m) * a.n * g.n / (a.n + g.n)))"
)


@dataclass(frozen=True)
class Facts:
    """What one scan tells about a column; `brackets` has two bounds for each quartile."""

    count: int
    mean: float | None
    std: float | None
    low: float | None
    high: float | None
    brackets: list[tuple[float, float]]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def _array(numbers: list[float]) -> str:
    return f"array({', '.join(f'{x!r}D' for x in numbers)})"


def survey(
    df: DataFrame, columns: list[str], counts: list[str] = (), accuracy: int = SKETCH_ACCURACY, steps: int = SKETCH_STEPS
) -> tuple[list[int], dict[str, Facts]]:
    """One scan: the `counts` (SQL aggregates that merge by addition) and the facts of each column.

    Sketches of many thousand tasks would queue for one merging task, so tasks merge in groups first.  Each group hands
    on evenly spaced quantiles and its row count, and the quantiles of these weighted points are off by no more than
    one step and the sketch's error, however differently the groups are distributed.  A row for each column is fetched.
    """
    numbers = df.withColumns({f"_c{i}": nan_to_null(c).cast("double") for i, c in enumerate(columns)}).withColumn("_part", F.spark_partition_id() % SKETCH_GROUPS)
    spaced = _array([i / steps for i in range(steps + 1)])
    per_group, structs = [F.expr(text).alias(f"k{j}") for j, text in enumerate(counts)], []
    for i in range(len(columns)):
        v = f"_c{i}"
        found = {"n": f"count({v})", "m": f"avg({v})", "s": f"var_pop({v}) * count({v})", "low": f"min({v})", "high": f"max({v})", "q": f"percentile_approx({v}, {spaced}, {accuracy})"}
        per_group += [F.expr(text).alias(f"{name}{i}") for name, text in found.items()]
        structs.append(f"named_struct('i', {i}, " + ", ".join(f"'{name}', {name}{i}" for name in found) + ")")
    extra = [f"k{j}" for j in range(len(counts))]
    # Without columns a group still has its counts.
    if not structs:
        groups = df.agg(*per_group).first() if per_group else []
        return [k or 0 for k in groups], {}
    groups = numbers.groupBy("_part").agg(*per_group)
    rows = groups.selectExpr(*extra, f"inline(array({', '.join(structs)}))")
    points = rows.selectExpr(*extra, "i", "n", "m", "s", "low", "high", "posexplode_outer(q) as (at, x)").withColumn("pos", F.expr("coalesce(at, 0)"))
    margin = 1.0 / steps + 3.0 / accuracy
    probes = _array([max(0.0, min(1.0, p + side * margin)) for p in QUARTILES for side in (-1, 1)])
    merged = points.groupBy("i").agg(
        *(F.expr(f"sum(if(pos = 0, {k}, 0))").alias(k) for k in extra),
        F.expr("sum(if(pos = 0, n, 0))").alias("n"),
        F.expr(_MOMENTS).alias("moments"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.expr(f"percentile(x, {probes}, n)").alias("ends"),
    )
    found = {row["i"]: row for row in merged.collect()}
    if not found:
        return [0] * len(counts), {c: Facts(0, None, None, None, None, []) for c in columns}
    facts = {}
    for i, c in enumerate(columns):
        row, n = found[i], found[i]["n"]
        std = math.sqrt(row["moments"]["s"] / (n - 1)) if n > 1 else None
        ends = row["ends"] or []
        # At the outer ends a sketch's quantile is no bound, and of few rows the two that a quartile lies between can be
        # further apart than its error; the extremes always are bounds.
        few = n <= 4 * accuracy
        brackets = [
            (row["low"] if few or p - margin <= 0 else ends[2 * j], row["high"] if few or p + margin >= 1 else ends[2 * j + 1])
            for j, p in enumerate(QUARTILES if n else [])
        ]
        facts[c] = Facts(n, row["moments"]["m"] if n else None, std, row["low"], row["high"], brackets)
    return [found[0][k] for k in extra], facts


def _ranks(count: int, p: float) -> tuple[int, int, float]:
    """The two ranks a quantile lies between, from 0, and the share of the upper one."""
    position = (count - 1) * p
    return math.floor(position), math.ceil(position), position - math.floor(position)


def _bracketed(numbers: DataFrame, brackets: list[list[tuple[float, float]]]) -> DataFrame:
    """(i, b, x, n): of bracket b of column i how many values lie below it (x is null), and each value in it, once for each
    batch.  As rows for Spark it would be one for each value and bracket, so a batch is counted at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for i, column in enumerate(batch.columns):
                v = column.drop_null().to_numpy(zero_copy_only=False)
                for b, (low, high) in enumerate(brackets[i]):
                    held, n = np.unique(v[(v >= low) & (v <= high)], return_counts=True)
                    below = np.array([(v < low).sum()])
                    at = [np.full(len(held) + 1, k) for k in (i, b)]
                    parts.append((*at, pa.concat_arrays([pa.nulls(1, pa.float64()), pa.array(held, pa.float64())]), np.concatenate([below, n])))
            kinds = (pa.int32(), pa.int32(), pa.float64(), pa.int64())
            columns = [pa.concat_arrays([pa.array(p[k], kind) if k != 2 else p[k] for p in parts]) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "b", "x", "n"])

    return numbers.mapInArrow(run, "i int, b int, x double, n bigint")


def quartiles(df: DataFrame, facts: dict[str, Facts]) -> DataFrame:
    """(column, quartiles): the exact quartiles of columns with at least one value, in the order of `QUARTILES`.

    Values in a bracket are counted as one row if equal and put in order bracket by bracket.  A rank outside its bracket raises; by the sketches'
    bounds there is none.
    """
    columns = [c for c, f in facts.items() if f.count]
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, quartiles array<double>")
    numbers = df.select(*(nan_to_null(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)))
    counted = _bracketed(numbers, [facts[c].brackets for c in columns]).groupBy("i", "b", "x").agg(F.sum("n").alias("n"))
    # The row of what lies below sorts first.
    order = Window.partitionBy("i", "b").orderBy(F.asc_nulls_first("x")).rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("last", F.sum("n").over(order)).where("x is not null")
    ranks = [[_ranks(facts[c].count, p) for p in QUARTILES] for c in columns]
    wanted = ", ".join("array(" + ", ".join(f"array({below}L, {above}L)" for below, above, _ in of) + ")" for of in ranks)
    hits = placed.selectExpr("i", "b", "x", "n", "last", f"posexplode(array({wanted})[i][b]) as (side, rank)").where("rank < last and rank >= last - n")
    picks = [F.max(F.when((F.col("b") == j) & (F.col("side") == side), F.col("x"))).alias(f"v{j}{side}") for j in range(len(QUARTILES)) for side in (0, 1)]
    found = hits.groupBy("i").agg(*picks)
    all_of_them = F.create_map(*(F.lit(x) for i, c in enumerate(columns) for x in (i, c)))
    shares = f"array({', '.join(_array([share for *_, share in of]) for of in ranks)})[i]"
    message = "'a quartile lies outside its bracket: the table changed between two reads, or a sketch was off'"
    between = [f"if(v{j}0 is null or v{j}1 is null, cast(raise_error({message}) as double), v{j}0 + (v{j}1 - v{j}0) * {shares}[{j}])" for j in range(len(QUARTILES))]
    # A column without any hit is missing here; the left join from all columns shows it.
    columns_of = df.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("i"))
    return columns_of.join(found, "i", "left").select(F.element_at(all_of_them, F.col("i")).alias("column"), F.expr(f"array({', '.join(between)})").alias("quartiles"))


def summarised(df: DataFrame, facts: dict[str, Facts]) -> DataFrame:
    """The summary rows of surveyed columns; reads `df` once, when the result is read."""
    spark = df.sparkSession
    shape = "position int, column string, count bigint, mean double, std double, min double, max double"
    rows = [(i, c, f.count, f.mean, f.std, f.low, f.high) for i, (c, f) in enumerate(facts.items())]
    known = spark.createDataFrame(rows, shape)
    found = quartiles(df, facts).withColumnRenamed("column", "_of")
    joined = known.join(found, known["column"] == found["_of"], "left")
    return joined.select("column", "count", "mean", "std", "min", *(F.get("quartiles", F.lit(j)).alias(q) for j, q in enumerate(("q25", "q50", "q75"))), "max")


def numeric_summary(
    df: DataFrame, columns: list[str] | None = None, accuracy: int = SKETCH_ACCURACY, steps: int = SKETCH_STEPS
) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of every numeric column, one row per column.

    Quartiles interpolate between neighbouring values.  Null and NaN are skipped.  All numbers count as doubles, so whole
    numbers and decimals beyond 2^53 count as the nearest double.  One job over `df` runs right away and fetches a row
    for each column; the result reads `df` once more.  Write an expensive `df` to a table first.
    """
    _, facts = survey(df, numeric_columns(df) if columns is None else columns, accuracy=accuracy, steps=steps)
    return summarised(df, facts)
