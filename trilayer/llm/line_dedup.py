"""Line de-duplication with levelled sorted runs of line hashes.

Documents come in batches, in any order.  A batch's line hashes are anti-joined with the runs stored so far: what no run
holds is new, and its owner is the batch's largest document with that line.  Then the batch adds its own run: new hashes
with owner, known ones with their document count and an owner only where it is larger than the runs' own.  When a level
holds `fan_out` runs, they are compacted into one run of the next level.  Runs are bucketed and sorted by hash, so the
anti-join reads them without a shuffle.  Runs and a list of them by level lie in one folder, from which a later job goes on.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.llm.common import SPACE, arrow_pass, free_name, id_and_text, same, shared_folder, stored, text_hash, texts

KEY = ["high", "low"]
RUN = "high long, low long, n_docs long, owner long"
LISTED = "version long, place long, level long, run string, buckets long"


def line_key(line: str) -> str:
    """White space stripped at both ends, A-Z lower-cased.  (`bytes.lower` changes ASCII only.)"""
    return line.strip(SPACE).encode().lower().decode()


def distinct_keys(text: str, min_chars: int) -> dict[str, int]:
    """The long keys of a text, numbered by first occurrence."""
    keys: dict[str, int] = {}
    for line in text.split("\n"):
        stripped = line.strip(SPACE)
        if len(stripped) >= min_chars:
            keys.setdefault(line_key(stripped), len(keys))
    return keys


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """A row for each document and distinct long key: doc_id, text_hash, number of the key in the text, 128-bit hash."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, hashes = [], []
        for text in texts(batch):
            keys = distinct_keys(text, min_chars)
            counts.append(len(keys))
            hashes += [xxhash.xxh3_128_digest(key.encode()) for key in keys]
        halves = np.frombuffer(b"".join(hashes), dtype=">i8").astype("int64").reshape(-1, 2)
        counts = np.array(counts, dtype="int64")
        rows = np.repeat(np.arange(len(counts)), counts)
        numbers = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
        rows = pa.array(rows, pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), batch.column(2).take(rows), pa.array(numbers, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
            names=["doc_id", "text_hash", "number", *KEY],
        )

    keyed = id_and_text(docs).withColumn("text_hash", text_hash(F.col("text")))
    return arrow_pass(keyed, convert, "doc_id long, text_hash long, number int, high long, low long")


class LineRuns:
    """The runs, by level.  A run has one row per hash: the documents of its batches that hold the line, and the largest of
    them or null, where an earlier run has one as large.

    They live in `folder`, a new one under the shared folder unless given.  Each change writes the next version of the list
    of runs; what no list names, as after a job that was cut off, does not count, and its batch can be added again.
    """

    def __init__(self, spark: SparkSession, fan_out: int = 4, folder: str | None = None):
        self.spark = spark
        self.fan_out = fan_out
        self.folder = folder or shared_folder(spark)
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.version = 0
        #: Per level, the runs as (name, buckets).
        self.levels: list[list[tuple[str, int]]] = [[]]

    @classmethod
    def load(cls, spark: SparkSession, folder: str, fan_out: int = 4) -> LineRuns:
        """The runs of a folder as its last list has them, to be gone on with."""
        runs = cls(spark, fan_out, folder)
        rows = spark.read.schema(LISTED).json(f"{folder}/list-*").collect()
        runs.version = max(row["version"] for row in rows)
        for row in sorted(rows, key=lambda row: row["place"]):
            if row["version"] == runs.version:
                runs.levels += [[] for _ in range(row["level"] + 1 - len(runs.levels))]
                runs.levels[row["level"]].append((row["run"], row["buckets"]))
        runs.buckets = next(buckets for level in runs.levels for _, buckets in level)
        return runs

    def _list(self) -> None:
        self.version += 1
        runs = [(level, run, buckets) for level, runs in enumerate(self.levels) for run, buckets in runs]
        rows = [(self.version, place, *run) for place, run in enumerate(runs)]
        self.spark.createDataFrame(rows, LISTED).coalesce(1).write.json(f"{self.folder}/list-{self.version:06}")

    def _written(self, rows: DataFrame) -> tuple[str, int]:
        """The rows as a bucketed sorted table.  Its catalog entry goes at once, the files stay with the folder."""
        run = f"line_run_{uuid.uuid4().hex}"
        tidy = rows.select(*KEY, "n_docs", "owner").repartition(self.buckets, "high")
        tidy.write.bucketBy(self.buckets, "high").sortBy(*KEY).option("path", f"{self.folder}/{run}").format("parquet").saveAsTable(run)
        self.spark.sql(f"drop table {run}")
        return run, self.buckets

    def _opened(self, run: str, buckets: int) -> DataFrame:
        self.spark.sql(
            f"create table {run} ({RUN}) using parquet clustered by (high) sorted by ({', '.join(KEY)}) into {buckets} buckets location '{self.folder}/{run}'"
        )
        rows = self.spark.table(run)
        self.spark.sql(f"drop table {run}")
        return rows

    def _compacted(self, runs: list[tuple[str, int]]) -> DataFrame:
        # Read as plain files: of a union of bucketed scans, Spark 4.1 takes the buckets for its partitions, leaves the
        # exchange out and keeps equal hashes of different runs apart.
        rows = self.spark.read.schema(RUN).parquet(*(f"{self.folder}/{run}" for run, _ in runs))
        return rows.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("owner").alias("owner"))

    def add(self, hashes: DataFrame) -> None:
        """Merge a batch: rows (doc_id, hash), one for each document and line.  Batches may come in any order of ids."""
        rows = hashes.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("owner"))
        # An anti-join that keeps its other half too: what no run holds is new, what one holds keeps an owner that is larger.
        for run in self.all():
            marked = rows.join(run.select(*KEY, F.col("owner").alias("held")), KEY, "left")
            rows = marked.withColumn("owner", F.when(F.col("held") >= F.col("owner"), None).otherwise(F.col("owner"))).drop("held")
        self.levels[0].append(self._written(rows))
        level = 0
        while len(self.levels[level]) >= self.fan_out:
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._written(self._compacted(self.levels[level])))
            self.levels[level] = []
            level += 1
        self._list()

    def all(self) -> list[DataFrame]:
        return [self._opened(*run) for runs in self.levels for run in runs]

    def totals(self) -> DataFrame:
        """One run over everything."""
        runs = [run for level in self.levels for run in level]
        return self._compacted(runs) if runs else self.spark.createDataFrame([], RUN)


def _batched(hashes: DataFrame, docs: DataFrame, batches: int) -> DataFrame:
    """`batch` 0 has the largest ids, the last batch the smallest and null.  Bounds are quantiles, so sizes are alike."""
    shares = [i / batches for i in range(1, batches)]
    found = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), shares, 1000)).first()[0] if shares else []
    bounds = sorted(set(found or []))
    batch = F.lit(0)
    for bound in bounds:
        batch = batch + F.when(F.col("doc_id") > bound, 0).otherwise(1)
    return hashes.withColumn("batch", batch)


def dropped_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4, fan_out: int = 4, runs: LineRuns | None = None, added: bool = False
) -> DataFrame:
    """For each document that loses lines: doc_id, text_hash and `numbers`, the dropped keys by number in the text.

    With `runs`, documents and owners count that were added to them before, by this or an earlier job; the documents are
    added to them too, unless they have been (`added`), as when earlier ones are judged anew after a later batch.
    """
    hashes = stored(_batched(line_hashes(docs, min_chars), docs, batches), ["batch"])
    runs = runs or LineRuns(docs.sparkSession, fan_out)
    for batch in range(0 if added else batches):
        runs.add(hashes.where(F.col("batch") == batch))
    # Written first: then both sides of the join come from plain exchanges, and a line of a third of all documents is
    # split by the adaptive skew join.
    common = stored(runs.totals().where((F.col("n_docs") >= min_docs) & F.col("owner").isNotNull()).select(*KEY, "owner"))
    return (
        hashes.join(common, KEY)
        .where(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("owner")))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("number").alias("numbers"))
    )


def _with_dropped(docs: DataFrame, dropped: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with the dropped numbers of each row in one more column, null where there are none."""
    name = free_name(docs, "dropped_numbers")
    other = dropped.select(F.col("doc_id").alias(f"{name}_id"), F.col("text_hash").alias(f"{name}_hash"), F.col("numbers").alias(name))
    match = same(docs["doc_id"].cast("long"), other[f"{name}_id"]) & same(text_hash(docs["text"]), other[f"{name}_hash"])
    # Lists that grow with the data are not broadcast at any size.
    return docs.join(other.hint("merge"), match, "left").select(*[docs[c] for c in docs.columns], name), name


def without_keys(text: str, numbers: set[int], min_chars: int) -> tuple[str, int]:
    """The text without the lines whose keys have these numbers, and how many lines went."""
    if not numbers:
        return text, 0
    keys, lines = distinct_keys(text, min_chars), text.split("\n")
    kept = [line for line in lines if keys.get(line_key(line)) not in numbers]
    return "\n".join(kept), len(lines) - len(kept)


def dedup_lines(docs: DataFrame, min_chars: int = 20, **options) -> DataFrame:
    """`docs` with the repeated lines dropped from `text`; all columns and rows stay, `n_chars` follows if there is one.

    Keys of at least `min_chars` code points that at least `min_docs` rows hold lose their lines everywhere but in the rows
    with the largest doc_id that holds them.  Rows count as documents of their own also when ids repeat.  A null id is
    below all others; a null text stays null.  A text may become empty, and its row stays.
    """
    rows, name = _with_dropped(docs, dropped_lines(docs, min_chars, **options))

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        place = batch.schema.get_field_index("text")
        numbers = batch.column(batch.schema.get_field_index(name)).to_pylist()
        out = [value if not drop else without_keys(value, set(drop), min_chars)[0] for value, drop in zip(batch.column(place).to_pylist(), numbers)]
        columns = [pa.array(out, pa.string()) if i == place else column for i, column in enumerate(batch.columns)]
        return pa.RecordBatch.from_arrays([c for c, n in zip(columns, batch.schema.names) if n != name], names=[n for n in batch.schema.names if n != name])

    text_first = rows.withColumn("text", F.col("text").cast("string"))
    kept = arrow_pass(text_first, convert, text_first.drop(name).schema)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def line_digest(docs: DataFrame, min_chars: int = 20, **options) -> DataFrame:
    """Per row of `docs`: doc_id, n_lines, n_dropped and the digest of the text that is left.  Null text: one empty line."""
    rows, name = _with_dropped(id_and_text(docs), dropped_lines(docs, min_chars, **options))

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines, gone, digests = [], [], []
        for text, drop in zip(texts(batch), batch.column(2).to_pylist()):
            kept, n = without_keys(text, set(drop or ()), min_chars)
            lines.append(text.count("\n") + 1)
            gone.append(n)
            digests.append(hashlib.sha256(kept.encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(lines, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())],
            names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )

    return arrow_pass(rows, convert, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
