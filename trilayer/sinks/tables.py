"""Table writes.  Each returns the number of rows written, counted by the write itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilayer.schemas import WAREHOUSE, conform, conversion_losses

TABLE_FORMAT = "parquet"

# Beside a table that is being recreated: the new one, the old one while names change, rows of a partitioned one in full.
NEXT, OLD, WHOLE = "__next", "__old", "__whole"


def _balanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Spread rows for a partitioned write.

    Rebalancing brings the rows of a table partition together, so that tasks do not each write a small file to every
    one, and lets the adaptive planner split a partition that holds a large share of the rows.
    """
    return df.hint("rebalance", *(F.col(c) for c in partition_by)) if partition_by else df


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows and an observation of their number, taken in the stage that writes them."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def recover_swap(spark: SparkSession, name: str, partition_by: list[str] | None = None) -> None:
    """Finish a recreation that was cut off after its rows had been written in full, undo one that was cut off before."""
    has = spark.catalog.tableExists
    if has(f"{name}{OLD}"):
        if not has(name):
            spark.sql(f"ALTER TABLE {name}{NEXT if has(f'{name}{NEXT}') else OLD} RENAME TO {name}")
        spark.sql(f"DROP TABLE IF EXISTS {name}{OLD}")
    if has(f"{name}{WHOLE}"):
        _rewrite(spark, name, partition_by or [])
    spark.sql(f"DROP TABLE IF EXISTS {name}{NEXT}")


def _rename(spark: SparkSession, name: str) -> None:
    """The new table takes the name, the old one being set aside until it has."""
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}{OLD}")
    spark.sql(f"ALTER TABLE {name}{NEXT} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name}{OLD}")


def _rewrite(spark: SparkSession, name: str, keys: list[str]) -> None:
    """Write the table from the rows staged in full, which can be repeated: not every catalog moves partitions along with
    a name."""
    rows = spark.read.table(f"{name}{WHOLE}")
    fmt = spark.sql(f"DESCRIBE EXTENDED {name}{WHOLE}").where("col_name = 'Provider'").first()["data_type"]
    _balanced(rows, keys).write.format(fmt).mode("overwrite").partitionBy(*keys).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}{WHOLE}")


def _partitioned(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and any(c.isPartition for c in spark.catalog.listColumns(name))


def write_table(
    df: DataFrame, name: str, partition_by: list[str] | None = None, fmt: str = TABLE_FORMAT, recreate: bool = False
) -> int:
    """Replace a table and its schema.

    With `recreate` the rows first go to a table beside it, which takes the name once it is whole, the old one being set
    aside until then: a failed write leaves the old table as it was, `df` may read it, and a run that is cut off
    between the two is finished by the next call or by `recover_swap`.
    """
    spark, keys = df.sparkSession, partition_by or []
    if recreate:
        recover_swap(spark, name, keys)
        rows, seen = observed(df)
        rows.write.format(fmt).mode("overwrite").saveAsTable(f"{name}{NEXT}")
        if keys or _partitioned(spark, name):
            spark.sql(f"ALTER TABLE {name}{NEXT} RENAME TO {name}{WHOLE}")
            _rewrite(spark, name, keys)
        else:
            _rename(spark, name)
    else:
        rows, seen = observed(_balanced(df, keys))
        rows.write.format(fmt).mode("overwrite").partitionBy(*keys).saveAsTable(name)
    return seen.get["rows"]


def replace_mapped(df: DataFrame, name: str, mapping: dict[str, str], fmt: str = TABLE_FORMAT) -> int:
    """Replace a table by the mapped columns only, source name -> target name."""
    return write_table(df.select(*(F.col(f"`{a}`").alias(b) for a, b in mapping.items())), name, fmt=fmt)


class Written(int):
    """Rows written, and how many of their values became null or were cut on the way."""

    nulled: int
    cut: int

    def __new__(cls, rows: int, nulled: int, cut: int) -> Written:
        written = super().__new__(cls, rows)
        written.nulled, written.cut = nulled, cut
        return written


def _load(df: DataFrame, name: str, schema: T.StructType, text_bytes: int | None, fmt: str, mode: str) -> Written:
    nulled, cut = conversion_losses(schema, text_bytes)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(nulled).alias("nulled"), F.sum(cut).alias("cut"))
    conform(counted, schema, text_bytes).write.format(fmt).mode(mode).saveAsTable(name)
    return Written(seen.get["rows"], seen.get["nulled"] or 0, seen.get["cut"] or 0)


def append_table(df: DataFrame, name: str, schema: T.StructType, text_bytes: int | None = None, fmt: str = TABLE_FORMAT) -> Written:
    """Append rows in the target's shape, creating the table if need be.  A second run adds the rows a second time.

    Text is cut to `text_bytes` only where that is given (`TEXT_BYTES` is the warehouse's limit); values that were cut or
    did not fit their type are counted in the result.
    """
    return _load(df, name, schema, text_bytes, fmt, "append")


def load_table(df: DataFrame, name: str, schema: T.StructType, text_bytes: int | None = None, fmt: str = TABLE_FORMAT) -> Written:
    """Like `append_table`, but a second run leaves the table as it is: the load replaces the table's content."""
    return _load(df, name, schema, text_bytes, fmt, "overwrite")


def copy_to_warehouse(
    tables: dict[str, DataFrame], layer: str = "warehouse", append: bool = True, text_bytes: int | None = None, fmt: str = TABLE_FORMAT
) -> dict[str, Written]:
    """Load tables named as in the warehouse list; rows written per table."""
    load = append_table if append else load_table
    return {name: load(df, f"{layer}.{name}", WAREHOUSE[name], text_bytes, fmt) for name, df in tables.items()}
