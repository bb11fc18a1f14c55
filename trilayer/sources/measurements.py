"""Air measurements: a tree of gzip CSV files."""

from __future__ import annotations

import csv
import gzip
import io
import logging
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.functions.paths import relative_path
from trilayer.schemas import MEASUREMENT_FILE
from trilayer.sources.existing import existing_paths

log = logging.getLogger(__name__)

# The pollutants kept.
POLLUTANTS = ["pm25", "no2", "o3", "co", "so2", "no", "nox", "pm10", "pm1"]

# The stations kept.
STATIONS = [
    384,
    625,
    626,
    628,
    631,
    648,
    664,
    665,
    666,
    292229,
    1824516,
    2616564,
    2903996,
    3041962,
    3181018,
    4727343,
    4811604,
    6091551,
    6166696,
]

_PIECE = 1 << 20


def listed_stations(df: DataFrame, key: str = "location_id", stations: list[int] | None = None) -> DataFrame:
    """Rows of the listed stations.  For a list kept in a table use `trilayer.operators.joins.keep_listed`."""
    return df.filter(F.col(key).isin(STATIONS if stations is None else stations))


def _header_if_whole(content: bytes) -> str | None:
    """The first line of a gzip file, or None if it is empty or cannot be inflated to its end.

    Inflates piece by piece and keeps the first line only.
    """
    try:
        with gzip.GzipFile(fileobj=io.BytesIO(content)) as stream:
            header = stream.readline()
            while stream.read(_PIECE):
                pass
    except (OSError, EOFError, zlib.error):
        return None
    return header.decode("utf-8-sig").strip() or None


def _columns(header: str) -> list[str]:
    return [name.strip() for name in next(csv.reader([header]))]


#: A field of a line as it is written, quotes and escapes included.
_FIELD = re.compile(rb'((?:"(?:\\.|[^"\\])*"|[^,"]|")*)(?:,|$)')


def _reordered(line: bytes, order: list[int]) -> bytes:
    """The fields at these places of a line, unchanged; an absent one is empty."""
    fields = [m.group(1) for m in _FIELD.finditer(line)]
    return b",".join(fields[i] if i < len(fields) else b"" for i in order)


def _gzip_files(spark: SparkSession, paths: list[str], glob: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(paths)
        .select(F.col("_metadata.file_path").alias("path"), "content")
    )


def damaged_files(spark: SparkSession, paths: list[str], glob: str = "*.csv.gz") -> DataFrame:
    """Paths of gzip files that are empty, end early or do not inflate.  The tasks read every byte."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            damaged = [_header_if_whole(content) is None for content in batch["content"]]
            yield batch.loc[damaged, ["path"]]

    return _gzip_files(spark, paths, glob).mapInPandas(check, "path string")


def _lines(path: str, content: bytes, wanted: list[str], skip_damaged: bool) -> Iterator[pa.RecordBatch]:
    """The lines below the header, a piece of the file at a time, fields in the order of `wanted`.

    The bytes are inflated to their end before a line is given out, and once more for the lines: so a damaged file gives
    none, and no more than a piece of the text is held.
    """
    header = _header_if_whole(content)
    if header is None:
        if not skip_damaged:
            raise ValueError(f"cannot be read to its end: {path}")
        log.warning("left out %s: cannot be read to its end", path)
        return
    names = _columns(header)
    if not set(wanted) <= set(names):
        raise ValueError(f"unexpected columns in {path}: {names}")
    order = [names.index(name) for name in wanted]
    with gzip.GzipFile(fileobj=io.BytesIO(content)) as stream:
        stream.readline()
        while piece := b"".join(stream.readlines(_PIECE)):
            lines = piece.decode("utf-8", "replace").encode().splitlines()
            if names != wanted:
                lines = [_reordered(line, order) for line in lines]
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(lines), pa.string()), pa.array(lines, pa.binary()).cast(pa.string())], names=["path", "line"])


def scan_measurements(
    spark: SparkSession,
    paths: list[str],
    base: str = "",
    pollutants: list[str] | None = None,
    skip_damaged: bool = True,
) -> DataFrame:
    """All measurement files below `paths` as one relation, with the file each row came from.

    * An absent path is logged and left out.
    * Path segments `locationid=…/year=…/month=…` do not become columns.
    * A file is read once, by the task that inflates it, checks it and gives out its lines; the JVM parses them.  Nothing
      about the files comes to the driver.
    * Columns are found by their names in each file's header, which may be quoted or in another order.  A whole file
      that lacks a column fails the job.
    * With `skip_damaged`, a file that cannot be read to its end gives no rows at all and is logged by its task;
      `damaged_files` lists such files.  Spark alone would keep the rows before the damage.  Without it such a file
      fails the job.
    """
    wanted = POLLUTANTS if pollutants is None else pollutants
    paths = existing_paths(spark, paths)
    if not paths:
        raise ValueError("none of the measurement paths exists")
    names = MEASUREMENT_FILE.names

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                yield from _lines(path.as_py(), content.as_py(), names, skip_damaged)

    lines = _gzip_files(spark, paths, "*.csv.gz").mapInArrow(unpack, "path string, line string")
    kinds = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in MEASUREMENT_FILE)
    # As in a file scan, lines of nothing but blanks and controls are no rows.
    rows = lines.filter(F.col("line").rlike(r"[^\x00-\x20]")).select(F.from_csv("line", kinds).alias("row"), "path")
    rows = rows.select("row.*", "path").filter(F.col("parameter").isin(wanted))
    return rows.withColumn("source_file", relative_path(F.col("path"), base) if base else F.col("path")).drop("path")
