"""What the operators share: stored intermediates, Arrow passes, word rules.

Every operator reads the two columns it needs and builds its result from them, so other columns of its input may have any
name, also one that the operator uses itself.  Functions that return whole documents keep every input column.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: `[\x20\x09-\x0D]`, the characters between words and at line ends.  Fixed values.
SPACE = " \t\n\x0b\x0c\r"

#: Bytes to bytes: A-Z lower-cased, other ASCII but 0-9 and a-z to a space, all non-ASCII kept.
PLAIN_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def plain_words(text: str) -> list[bytes]:
    """The words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a text with A-Z lower-cased, as UTF-8."""
    return text.encode().translate(PLAIN_WORDS).split()


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share: under `spark.checkpoint.dir`, where the session has one.

    Without that setting a local session takes a temporary folder; a cluster session is refused, because its executors
    would each write to a disk of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """The rows of `df`, written once to the shared folder and read from there: a lost executor costs no recomputation,
    and later plans start from files.  Like checkpoints, the files go with the folder."""
    folder = shared_folder(df.sparkSession)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def arrow_pass(df: DataFrame, convert: Callable[[pa.RecordBatch], pa.RecordBatch | list], schema: str) -> DataFrame:
    """One Python pass over the rows, a batch at a time.  Spark bounds a batch by rows and by bytes, a single longer text
    makes a batch of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield convert(batch)
            # A worker lives on for later stages; what this batch took goes back to the system.
            del batch
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[str]:
    """The texts of a batch one by one, null as the empty text."""
    for value in batch.column(batch.schema.get_field_index(column)):
        yield value.as_py() or ""


def same(left: Column, right: Column) -> Column:
    """Equality for joins on document ids, of which null is one."""
    return left.eqNullSafe(right)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_hash(text: Column) -> Column:
    """Tells rows apart that share an id; rows equal in both are treated alike anyway."""
    return F.xxhash64(text.cast("string"))


def id_and_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
