"""Trip files: one Parquet file or folder per month, with drifting types and names."""

from __future__ import annotations

import logging
import os
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilayer.functions.paths import TRIP_FILE_FORMAT
from trilayer.sources.existing import is_absent

log = logging.getLogger(__name__)

# Fixed value: the column that changed its spelling between months, in the form that is kept.
FOLDED_NAMES = ["airport_fee"]


def trip_paths(base: str, years: Iterable[int] = (2023, 2024)) -> list[str]:
    """The monthly paths of whole years."""
    return [f"{base.rstrip('/')}/" + TRIP_FILE_FORMAT % (y, y, m) for y in years for m in range(1, 13)]


def harmonize(df: DataFrame, folded: Iterable[str] = tuple(FOLDED_NAMES)) -> DataFrame:
    """Widen int columns to long and fold spelling variants of `folded` columns; other columns pass."""
    lower = {name.lower() for name in folded}
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegerType):
            column = column.cast("long")
        name = field.name.lower() if field.name.lower() in lower else field.name
        columns.append(column.alias(name))
    return df.select(*columns)


def union_drifted(parts: Iterable[DataFrame]) -> DataFrame:
    """Union by name; a column missing in one part is null there, int and double meet as double."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (harmonize(p) for p in parts))


#: Signs of a file that is no Parquet, or not a whole one.
NO_PARQUET = ("CANNOT_READ_FILE_FOOTER", "is not a Parquet file", "UNABLE_TO_INFER_SCHEMA")


#: Paths or files that a task of the census opens.
PER_TASK = 64

_LISTED = "path string, file string, outcome string"
_FOOTERS = "path string, file string, form string, outcome string"
_ABSENT, _STORE, _FOUND = "no such path", "store is not known to the tasks", "found"


def _opened(path: str):
    """The file system of a qualified path and the path in it; None where only Spark's readers know the store."""
    try:
        return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ImportError):
        return None


def _files_below(path: str) -> list[tuple[str | None, str]]:
    """The data files of a path, itself or those below it, or why there are none."""
    store = _opened(path)
    if store is None:
        return [(None, _STORE)]
    system, inner = store
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        return [(None, _ABSENT)]
    if info.is_file:
        return [(path, _FOUND)]
    below = system.get_file_info(fs.FileSelector(inner, recursive=True))
    names = (entry.path[len(inner.rstrip("/")) + 1 :] for entry in below if entry.is_file)
    return [(f"{path.rstrip('/')}/{name}", _FOUND) for name in sorted(names) if not any(part[0] in "_." for part in name.split("/"))]


def _form(file: str) -> tuple[str | None, str]:
    """A Parquet file's physical columns, and what Spark noted of them, as text; or why it has none."""
    system, inner = _opened(file)
    with system.open_input_file(inner) as source:
        try:
            footer = pq.read_metadata(source)
        except pa.ArrowInvalid as problem:
            return None, str(problem).splitlines()[0]
    noted = (footer.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"").decode()
    return str(footer.schema).split("\n", 1)[1] + noted, _FOUND


def footer_census(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, file, form and outcome of all files of the qualified `paths`, listed and their footers read by the tasks.

    Two files of the same `form` have the same schema.  A null form: nothing is there, the file is no Parquet, or the
    store is one that the tasks cannot open by its address.  A refused or failed read fails the job.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(path, *found) for path in batch.column(0).to_pylist() for found in _files_below(path)]
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.string()) for column in zip(*rows)] if rows else [pa.array([], pa.string())] * 3, names=["path", "file", "outcome"])

    def formed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outcomes = batch.column(2).to_pylist()
            found = [_form(file) if outcome == _FOUND else (None, outcome) for file, outcome in zip(batch.column(1).to_pylist(), outcomes)]
            forms, outcomes = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(forms, pa.string()), pa.array(outcomes, pa.string())], names=["path", "file", "form", "outcome"])

    def tasks(n: int) -> int:
        return max(1, min(-(-n // PER_TASK), 2 * spark.sparkContext.defaultParallelism, n))

    rows = spark.createDataFrame(pd.DataFrame({"path": paths}, dtype=object), "path string")
    files = rows.repartition(tasks(len(paths))).mapInArrow(listed, _LISTED)
    # Anew by file: one folder may hold nearly all of them.
    return files.repartition(2 * spark.sparkContext.defaultParallelism, "file").mapInArrow(formed, _FOOTERS)


def _qualified(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Paths by their addresses; those without a store are in the cluster's default one."""
    store = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS").rstrip("/")
    return {path if "://" in path or path.startswith("file:") else store + ("//" if store == "file:" else "") + os.path.abspath(path): path for path in paths}


def _schemas_by_driver(spark: SparkSession, paths: list[str], threads: int = 16) -> tuple[dict[str, list[str]], dict[str, T.StructType], dict[str, str]]:
    """The same as the census finds, for stores that only Spark's readers know: one listing call for each path and one
    read for each file."""

    def files_of(path: str):
        try:
            return spark.read.schema("_ int").parquet(path).inputFiles() or [path], None
        except PySparkException as problem:
            if not is_absent(problem):
                raise
            return [], (path, str(problem).splitlines()[0])

    def probe(path: str):
        try:
            return path, spark.read.parquet(path).schema, None
        except (PySparkException, Py4JJavaError) as problem:
            if not any(sign in str(problem) for sign in NO_PARQUET):
                raise
            return path, None, str(problem).splitlines()[0]

    with ThreadPoolExecutor(max_workers=threads) as pool:
        listed = list(pool.map(files_of, paths))
        found = list(pool.map(probe, [file for files, _ in listed for file in files]))
    members: dict[str, list[str]] = defaultdict(list)
    schemas = {}
    for path, schema, _ in found:
        if schema is not None:
            members[schema.json()].append(path)
            schemas[schema.json()] = schema
    skipped = dict(absent for _, absent in listed if absent) | {path: reason for path, schema, reason in found if schema is None}
    return members, schemas, skipped


def read_schemas(spark: SparkSession, paths: list[str]) -> tuple[list[tuple[T.StructType, list[str]]], dict[str, str]]:
    """The distinct schemas with the files that have them, and the reason for each path or file left out.

    A path may be a folder: its files are taken one by one, as each may have a schema of its own.  Left out are paths
    where nothing is and files that are no Parquet; a refused or failed read is raised.  The tasks list the paths and read
    the footers; the driver gets the names of the files and reads one footer for each distinct form.
    """
    named = _qualified(spark, paths)
    census = footer_census(spark, list(named)).collect()
    members: dict[str, list[str]] = defaultdict(list)
    skipped: dict[str, str] = {}
    for row in sorted(census, key=lambda r: (r["file"] or "", r["path"])):
        if row["form"] is not None:
            members[row["form"]].append(row["file"])
        elif row["outcome"] != _STORE:
            skipped[row["file"] or named[row["path"]]] = row["outcome"]
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for files in members.values():
        schema = spark.read.parquet(files[0]).schema
        groups.setdefault(schema.json(), (schema, []))[1].extend(files)
    unknown = [named[row["path"]] for row in census if row["outcome"] == _STORE]
    if unknown:
        others, schemas, absent = _schemas_by_driver(spark, unknown)
        for key, files in others.items():
            groups.setdefault(key, (schemas[key], []))[1].extend(files)
        skipped |= absent
    return list(groups.values()), skipped


def scan_trips(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All files of the paths as one relation; what `read_schemas` leaves out is logged.

    Files with the same schema share one scan, so the plan grows with the number of schemas, not of files.  Each scan
    keeps the vectorized reader and its own pushed-down filters.
    """
    groups, skipped = read_schemas(spark, paths)
    for path, reason in skipped.items():
        log.warning("left out %s: %s", path, reason)
    if not groups:
        raise ValueError("none of the trip paths can be read")
    return union_drifted(spark.read.schema(schema).parquet(*files) for schema, files in groups)
