"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Significant digits of a double that hold no error of one or two roundings.
SURE_DIGITS = 15

# Units that sums are counted in, the size from which a value is not counted but added as it is, and the bits of the lower
# piece of a number of millionths.
MICRO, FINE, ODD, PIECE = "1e6D", "1e12D", "1e9D", 24


def _half_up(value: str, digits: int) -> str:
    """SQL text of `stable_round`; one expression text costs one driver round trip, its many nodes as Columns dozens."""
    size = f"abs({value})"
    # Decimals that the sure digits reach: the value as a whole number of them, then whole-number rounding.
    decimals = f"({SURE_DIGITS - 1} - cast(floor(log10({size})) as int))"
    whole = f"cast(rint({size} * power(10D, {decimals})) as bigint)"
    unit = f"cast(power(10D, {decimals} - {digits}) as bigint)"
    nearest = f"signum({value}) * (({whole} + {unit} div 2L) div {unit} / {10**digits}D)"
    return (
        f"case when {size} < {0.4 * 10**-digits}D then 0D * {value} "
        f"when {size} < {10 ** (SURE_DIGITS - 1 - digits)}D then {nearest} else round({value}, {digits}) end"
    )


def stable_round(column: str, digits: int) -> Column:
    """Half-up rounding of a double by its first 15 significant digits, halves away from zero.

    A double that stands for a decimal, off by a rounding or two, is rounded as that decimal.  It does not mend a sum of
    doubles whose order varies: its noise grows with the rows, so sum with `exact_sum` or `exact_mean` first.  Values
    whose 15 digits end at or before the position are rounded as they are.

    It is whole-number arithmetic, which stays in generated code; the built-in `round` goes through a big decimal for
    each value.
    """
    return F.expr(_half_up(f"`{column}`", digits))


def exact_parts(value: str) -> dict[str, str]:
    """SQL text of the aggregates that an exact sum of a double expression consists of; each merges by plain sums.

    A double is taken as a whole number of millionths, which it is if it stands for a decimal of up to six places, in two
    pieces, and the rest as a whole number of 1e-12.  These are added as longs, so neither the order of the rows nor the way
    they are spread over tasks can change the sum; 1.5e11 rows of any size fit, an overflow raises.  Values from 1e9 on, infinities and
    NaN are added as doubles.
    """
    counted = f"abs({value}) < {ODD}"
    micro = f"cast(if({counted}, rint(({value}) * {MICRO}), null) as bigint)"
    rest = f"if({counted}, rint((({value}) - rint(({value}) * {MICRO}) / {MICRO}) * {FINE}), null)"
    return {
        "high": f"sum(shiftright({micro}, {PIECE}))",
        "low": f"sum({micro} & {(1 << PIECE) - 1}L)",
        "fine": f"sum(cast({rest} as bigint))",
        "odd": f"sum(if({counted}, null, {value}))",
        "count": f"count({value})",
    }


def exact_total(parts: dict[str, str]) -> str:
    """SQL text of the sum as a double, from the (merged) aggregates; null without rows."""
    micro = f"(cast({parts['high']} as decimal(20,0)) * {1 << PIECE}BD + {parts['low']})"
    counted = f"cast(cast({micro} * 1000000BD + {parts['fine']} as decimal(38,0)) as double) / {FINE}"
    return f"if({parts['count']} = 0, null, coalesce({counted}, 0D) + coalesce({parts['odd']}, 0D))"


def exact_sum(value: str) -> Column:
    """Sum of a double expression that is the same however its rows are spread."""
    return F.expr(exact_total(exact_parts(value)))


def exact_mean(value: str) -> Column:
    """Mean of a double expression that is the same however its rows are spread."""
    parts = exact_parts(value)
    return F.expr(f"try_divide({exact_total(parts)}, cast({parts['count']} as double))")


def round_columns(df: DataFrame, columns: list[str], digits: int) -> DataFrame:
    """The same columns with some rounded by `stable_round`."""
    return df.withColumns({c: stable_round(c, digits) for c in columns})


def nan_to_null(column: str) -> Column:
    """NaN passes `> 0` in Spark; treat it as missing, as a null."""
    return F.expr(f"if(isnan(`{column}`), null, `{column}`)")


def to_float(column: str) -> Column:
    """Null for text that is no number, and for NaN."""
    return F.expr(f"nullif(try_cast(`{column}` as double), double('NaN'))")


def to_int(column: str) -> Column:
    """Truncates toward zero.  Null for text that is no number."""
    return F.expr(f"try_cast(try_cast(`{column}` as double) as int)")


def safe_corr(x: str, y: str) -> Column:
    """Pearson correlation over the rows where both are present and no NaN; null for constants or fewer than two rows.

    The built-in `corr` raises a division error for constant input under ANSI mode, so it is put together from
    covariance and deviations, all of which merge partial results.
    """
    missing = " or ".join(f"`{c}` is null or isnan(`{c}`)" for c in (x, y))
    px, py = (f"if({missing}, null, cast(`{c}` as double))" for c in (x, y))
    return F.expr(
        f"if(min({px}) < max({px}) and min({py}) < max({py}), "
        f"try_divide(covar_pop({px}, {py}), stddev_pop({px}) * stddev_pop({py})), null)"
    )
