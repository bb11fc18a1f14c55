"""Which of some paths can be listed."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


def is_absent(problem: Exception) -> bool:
    """Whether a read failed because nothing is there; refusals and failures of the store are something else."""
    return isinstance(problem, AnalysisException) and problem.getCondition() == "PATH_NOT_FOUND"


def existing_paths(spark: SparkSession, paths: list[str], threads: int = 16) -> list[str]:
    """The paths that exist, in order; absent ones are logged, any other error is raised.  Spark refuses a scan with an
    absent root path."""

    def exists(path: str) -> bool:
        try:
            spark.read.format("binaryFile").load(path)
            return True
        except AnalysisException as problem:
            if is_absent(problem):
                return False
            raise

    with ThreadPoolExecutor(max_workers=threads) as pool:
        found = dict(zip(paths, pool.map(exists, paths)))
    for path in (p for p, there in found.items() if not there):
        log.warning("left out %s: no such path", path)
    return [p for p in paths if found[p]]
