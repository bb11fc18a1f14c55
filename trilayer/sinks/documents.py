"""JSON sinks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_lines(df: DataFrame) -> DataFrame:
    """Each row as one JSON text, nulls kept."""
    return df.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"}).alias("line"))


def write_json_lines(df: DataFrame, path: str) -> None:
    """A folder of JSON-lines files, one per task."""
    json_lines(df).write.mode("overwrite").text(path)


def report_path(folder: str, name: str, at: datetime) -> str:
    return f"{folder.rstrip('/')}/{name}_{at:%Y%m%d_%H%M%S}.json"


def save_report(report: DataFrame, folder: str, at: datetime, name: str = "weather_quality_report") -> str:
    """A one-row report as one time-stamped JSON file; returns its path.

    Spark writes a folder beside it, whose single part takes the path once it is whole.
    """
    path = report_path(folder, name, at)
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}.parts")
    jvm = report.sparkSession._jvm
    parts, target = jvm.org.apache.hadoop.fs.Path(f"{path}.parts"), jvm.org.apache.hadoop.fs.Path(path)
    files = parts.getFileSystem(report.sparkSession._jsparkSession.sessionState().newHadoopConf())
    part = next(f.getPath() for f in files.listStatus(parts) if f.getPath().getName().startswith("part-"))
    files.delete(target, False)
    if not files.rename(part, target):
        raise OSError(f"could not rename {part} to {target}")
    files.delete(parts, True)
    return path
