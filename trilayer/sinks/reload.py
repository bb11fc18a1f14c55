"""Reload of a time range in a table partitioned by key and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trilayer.operators.reload import outside_bounds, time_bounds
from trilayer.sinks.tables import TABLE_FORMAT, _balanced, observed

DAY = "day"

# What a reload keeps beside the table: rows being staged, rows staged in full, partitions left without rows.
STAGING, STAGED, EMPTIED = "__staging", "__staged", "__emptied"
DROPPED_AT_ONCE = 1000


def _with_day(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(DAY, F.to_date(ts))


def create_time_table(df: DataFrame, name: str, key: str, ts: str, fmt: str = TABLE_FORMAT) -> int:
    """A table partitioned by key and day of `ts`."""
    rows, seen = observed(_balanced(_with_day(df, ts), [key, DAY]))
    rows.write.format(fmt).mode("overwrite").partitionBy(key, DAY).saveAsTable(name)
    return seen.get["rows"]


def _partitions(spark: SparkSession, name: str, key: str) -> DataFrame:
    """Key and day of the table's partitions, from the catalog."""
    parts = F.split("partition", "/")

    def value(i: int) -> Column:
        # A plus sign stands for itself in partition names, other signs are percent-encoded.
        return F.url_decode(F.replace(F.substring_index(parts[i], "=", -1), F.lit("+"), F.lit("%2B")))

    return spark.sql(f"SHOW PARTITIONS {name}").select(value(0).alias(key), value(1).try_cast("date").alias(DAY))


def _staged_rows(batch: DataFrame, name: str, key: str, ts: str) -> tuple[DataFrame, DataFrame]:
    """What the partitions that the batch touches shall hold, with `_new` for its own rows; the partitions left without rows."""
    spark = batch.sparkSession
    table = spark.read.table(name)
    bounds = time_bounds(batch, key, ts)
    spans = bounds.select(
        F.col(key).alias("_key"), F.to_date("min_ts").alias("_first"), F.to_date("max_ts").alias("_last")
    )
    edges = spans.select("_key", F.explode(F.array_distinct(F.array("_first", "_last"))).alias("_edge"))
    edge_days = [row[0] for row in edges.select("_edge").distinct().collect()]

    on_edge = (F.col(key) == F.col("_key")) & (F.col(DAY) == F.col("_edge"))
    touched = table.filter(F.col(DAY).isin(edge_days)).join(edges, on_edge, "left_semi")
    kept = outside_bounds(touched, bounds, key, ts).withColumn("_new", F.lit(False))
    fresh = _with_day(batch, ts).select(*table.columns).withColumn("_new", F.lit(True))

    within = (F.col(key) == F.col("_key")) & F.col(DAY).between(F.col("_first"), F.col("_last"))
    batch_days = fresh.select(key, DAY).distinct()
    emptied = _partitions(spark, name, key).join(spans, within, "left_semi").join(batch_days, [key, DAY], "left_anti")
    return kept.unionByName(fresh), emptied


def _stage(batch: DataFrame, name: str, key: str, ts: str) -> int:
    """Write both to tables beside the target.  A reload counts from the moment the staged rows have their final name; that
    table has no partitions, because not every catalog moves these along with a name."""
    spark = batch.sparkSession
    rows, emptied = _staged_rows(batch, name, key, ts)
    emptied.write.mode("overwrite").saveAsTable(f"{name}{EMPTIED}")
    seen = Observation()
    rows = rows.observe(seen, F.count_if("_new").alias("rows"))
    rows.drop("_new").write.mode("overwrite").saveAsTable(f"{name}{STAGING}")
    spark.sql(f"ALTER TABLE {name}{STAGING} RENAME TO {name}{STAGED}")
    return seen.get["rows"]


def _swap_in(spark: SparkSession, name: str) -> None:
    """Overwrite the partitions that staged rows belong to.  Which ones are overwritten is a setting of the session, so
    this goes through a session of its own and other writers keep theirs."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    columns = spark.read.table(name).columns
    rows = own.read.table(f"{name}{STAGED}").select(*columns)
    # A time table's partition columns, the key and the day, are its last ones.
    _balanced(rows, columns[-2:]).write.mode("overwrite").insertInto(name)
    spark.catalog.refreshTable(name)


def _drop_emptied(spark: SparkSession, name: str) -> None:
    """Drop the partitions left without rows, `DROPPED_AT_ONCE` in a statement."""
    emptied = spark.read.table(f"{name}{EMPTIED}")
    key = emptied.columns[0]
    text = F.replace(F.replace(F.col(key).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    specs = emptied.select(F.format_string(f"PARTITION (`{key}`='%s', `{DAY}`='%s')", text, F.col(DAY).cast("string")))
    waiting = []
    for row in specs.toLocalIterator():
        waiting.append(row[0])
        if len(waiting) == DROPPED_AT_ONCE:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(waiting)}")
            waiting = []
    if waiting:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(waiting)}")


def _forget(spark: SparkSession, name: str) -> None:
    """Remove what a reload left beside the table; the staged rows first, for while they are there it counts as unfinished."""
    for suffix in (STAGED, STAGING, EMPTIED):
        spark.sql(f"DROP TABLE IF EXISTS {name}{suffix}")


def recover(spark: SparkSession, name: str) -> bool:
    """Finish or undo a reload of the table that was cut off; whether one was finished.

    Once the staged rows have their final name the reload is finished, which can be repeated any number of times: the swap overwrites
    the same partitions by the same rows, and a partition is dropped if it is still there.  Before that the table
    is untouched, and what was staged goes.
    """
    staged = spark.catalog.tableExists(f"{name}{STAGED}")
    if staged:
        _swap_in(spark, name)
        _drop_emptied(spark, name)
    _forget(spark, name)
    return staged


def replace_range(batch: DataFrame, name: str, key: str, ts: str) -> int:
    """Replace the rows of the batch's keys within the batch's time bounds by the batch; returns the batch's row count.

    Only the first and the last day of a key's range can hold rows that stay, so only these days are read: the distinct
    edge days are fetched, at most as many as the calendar has, and prune the scan as literals.

    The new content of every touched partition is written to a table beside the target, then swapped in by
    one overwrite of these partitions; partitions in between for which the batch has no rows are dropped a thousand at a time.  A
    run that is cut off at any point loses no row: the next call, or `recover`, finishes it or undoes it.  On plain
    files readers can see the swap half done.

    A repeated run gives the same table.  The batch is read several times and must not read from the table; pass a table
    or files, not an expensive query.
    """
    spark = batch.sparkSession
    recover(spark, name)
    if not batch.filter(F.col(key).isNull() | F.col(ts).isNull()).isEmpty():
        raise ValueError(f"rows without {key} or {ts} cannot be placed")
    rows = _stage(batch, name, key, ts)
    recover(spark, name)
    return rows
