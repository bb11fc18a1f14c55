"""Joins to dimensions and allow lists, and sums over the star.

No join carries a broadcast hint.  The optimizer broadcasts a side whose estimated or, at run time, measured size is
below `spark.sql.autoBroadcastJoinThreshold`; a bigger one takes a sort-merge join whose skewed partitions are split by
the adaptive skew join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.functions.numeric import exact_parts, exact_total


def keep_listed(df: DataFrame, allowed: DataFrame, key: str, allowed_key: str) -> DataFrame:
    """Rows whose key is in the allow list.  Order and duplicates of the list do not matter."""
    listed = allowed.select(F.col(allowed_key).alias("_listed"))
    return df.join(listed, F.col(key) == F.col("_listed"), "left_semi")


def with_dimension(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, attributes: list[str]) -> DataFrame:
    """The fact with attributes of a dimension; a fact row without a match stays, with nulls."""
    picked = dim.select(F.col(dim_key).alias("_dim_key"), *attributes)
    return fact.join(picked, F.col(fact_key) == F.col("_dim_key"), "left").drop("_dim_key")


def one_row_per_key(dim: DataFrame, key: str) -> DataFrame:
    """The dimension, checked as it is read: a key that a second row has raises an error.  Null keys match nothing."""
    others = [c for c in dim.columns if c != key]
    rows = dim.filter(F.col(key).isNotNull()).groupBy(key).agg(*(F.first(c).alias(c) for c in others), F.count(F.lit(1)).alias("_rows"))
    message = F.concat(F.lit(f"more than one row of the dimension with {key} = "), F.col(key).cast("string"))
    checked = F.when(F.col("_rows") > 1, F.raise_error(message).cast(dim.schema[key].dataType)).otherwise(F.col(key))
    return rows.select(checked.alias(key), *others)


def _partials(agg: str, column: str, kind: str) -> dict[str, str]:
    """Aggregates as SQL text, by name, that a measure needs of the rows of a key; doubles are summed exactly."""
    name = f"`{column}`"
    if agg in ("sum", "avg") and kind in ("double", "float"):
        return exact_parts(f"cast({name} as double)")
    return {k: f"{k}({name})" for k in (["sum", "count"] if agg == "avg" else [agg])}


def _merged(agg: str, parts: dict[str, str]) -> Column:
    """The measure from its partial columns."""
    totals = {k: f"{k if k in ('min', 'max') else 'sum'}(`{name}`)" for k, name in parts.items()}
    total = exact_total(totals) if "odd" in totals else totals.get("sum")
    if agg == "avg":
        return F.expr(f"try_divide({total}, cast({totals['count']} as double))")
    return F.expr(total if agg == "sum" else totals[agg])


def star_query(
    fact: DataFrame,
    dims: list[tuple[DataFrame, str, str]],
    by: list[str],
    measures: dict[str, tuple[str, str]],
) -> DataFrame:
    """Measures of a fact grouped by attributes of its dimensions.

    `dims` lists (dimension, fact key, dimension key), `measures` maps an output name to (aggregate, fact column) with
    sum, count, min, max or avg.  The fact is first aggregated by its own keys, with partial sums in each task, so a
    key that holds a large share of the rows reaches the join as few rows, and only then joined and merged.  A second
    row of a dimension key would count the fact twice; it fails the query.
    """
    home = [c for c in by if c in fact.columns]
    keys = list(dict.fromkeys([fact_key for _, fact_key, _ in dims] + home))
    kinds = dict(fact.dtypes)
    parts = {(agg, c): _partials(agg, c, kinds[c]) for agg, c in measures.values()}
    texts = dict.fromkeys(text for found in parts.values() for text in found.values())
    partial = {text: f"_part{i}" for i, text in enumerate(texts)}
    small = fact.groupBy(*keys).agg(*(F.expr(text).alias(name) for text, name in partial.items()))

    def attach(df: DataFrame, dim: tuple[DataFrame, str, str]) -> DataFrame:
        table, fact_key, dim_key = dim
        return with_dimension(df, one_row_per_key(table, dim_key), fact_key, dim_key, [c for c in by if c in table.columns and c not in home])

    joined = reduce(attach, dims, small)
    merged = [
        _merged(agg, {part: partial[text] for part, text in parts[agg, c].items()}).alias(name)
        for name, (agg, c) in measures.items()
    ]
    return joined.groupBy(*by).agg(*merged)
