"""Packing token sequences: shortest-pack-first over the length histogram.

Documents longer than a sequence are cut into full sequences and a rest.  Only the histogram of piece lengths, at most
`length` rows, reaches the driver.  Lengths are placed longest first, each piece into the shortest pack (the one with the
most room), counts of equal packs at a time; a piece that fits nowhere opens a new pack.  The result is, for each length,
which ranks go to which sequences; the pieces look their rank up.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trilayer.llm.common import arrow_pass, id_and_text, stored
from trilayer.llm.tokens import CachedTokenizer

#: Ends every document.
END_ID = 1
_TOKENIZERS: dict[str, CachedTokenizer] = {}


def tokenizer_of(path: str) -> CachedTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = CachedTokenizer(path)
    return _TOKENIZERS[path]


def pieces(docs: DataFrame, path: str, length: int) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, ids: every document's ids and `END_ID`, cut at multiples of `length`.

    `ids` holds the ids as little-endian unsigned 32-bit numbers, `ids_crc32` is the checksum of these bytes."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, start, sizes, sums, totals, packed = [], [], [], [], [], []
        for i, ids in enumerate(tokenizer_of(path).of_texts(batch.column(1))):
            ids = np.append(ids, END_ID).astype("<u4")
            for at in range(0, len(ids), length):
                piece = ids[at : at + length]
                row.append(i)
                start.append(at)
                sizes.append(len(piece))
                packed.append(piece.tobytes())
                sums.append(zlib.crc32(packed[-1]))
                totals.append(len(ids))
        numbers = [pa.array(x, pa.int64()) for x in (start, sizes, sums, totals)]
        columns = [batch.column(0).take(pa.array(row, pa.int64())), *numbers, pa.array(packed, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    return arrow_pass(id_and_text(docs), convert, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")


class Packs:
    """Open packs by room, as segments of equal packs: (count, last placed (length, pack before it))."""

    def __init__(self, histogram: dict[int, int], length: int):
        self.length = length
        self.open: dict[int, list[tuple[int, tuple | None]]] = {}
        for size in sorted(histogram, reverse=True):
            self._place(size, histogram[size])

    def _place(self, size: int, n: int) -> None:
        # Packs with the most room first.  Each gives room for one piece and moves on; a pack may come again in turn.
        rooms = sorted((r for r in self.open if r >= size), reverse=True)
        while n and rooms:
            room = rooms.pop(0)
            taken, rest = [], []
            for count, pack in self.open.pop(room):
                here = min(count, n)
                n -= here
                if here:
                    taken.append((here, (size, pack)))
                if count > here:
                    rest.append((count - here, pack))
            if rest:
                self.open[room] = rest
            left = room - size
            self.open.setdefault(left, []).extend(taken)
            if left >= size and left not in rooms:
                rooms.insert(bisect_right([-r for r in rooms], -left), left)
        if n:
            # What fits nowhere opens packs; the next ones of the same length go there first, as long as they fit.
            each = self.length // size
            for count, copies in ((n // each, each), (1, n % each)):
                if count and copies:
                    pack = None
                    for _ in range(copies):
                        pack = (size, pack)
                    self.open.setdefault(self.length - copies * size, []).append((count, pack))

    def runs(self) -> dict[int, dict[str, np.ndarray]]:
        """For each length, runs of ranks: the first rank, the sequence and the offset that it has there.  The next ranks
        of the run are in the next sequences at the same offset."""
        found: dict[int, list[tuple[int, int, int]]] = {}
        used: dict[int, int] = {}
        first = 0
        for _, segments in sorted(self.open.items()):
            for count, pack in segments:
                offset = 0
                while pack:
                    size, pack = pack
                    rank = used.get(size, 0)
                    found.setdefault(size, []).append((rank, first, offset))
                    used[size] = rank + count
                    offset += size
                first += count
        return {size: dict(zip(("rank", "sequence", "offset"), np.array(runs, dtype="int64").T)) for size, runs in found.items()}


def pack_documents(docs: DataFrame, path: str, length: int = 2048, cells: int = 256) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (see `pieces`).

    A null or empty text is the single id `END_ID`.  Rows that share an id are packed as documents of their own.  Pieces of
    one length are numbered within cells, whose numbers start where the counts of the cells before end, so no task holds
    all pieces of a common length.  The table of runs grows with the number of lengths and patterns, not with the data.
    """
    spark = docs.sparkSession
    cell = F.pmod(F.xxhash64("doc_id", "ids_crc32", "start"), F.lit(cells))
    all_pieces = stored(pieces(docs, path, length).withColumn("cell", cell))
    counts = all_pieces.groupBy("length", "cell").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    starts = stored(counts.select("length", "cell", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank")))
    histogram = {row["length"]: row["n"] for row in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.sparkContext.broadcast(Packs(histogram, length).runs())

    within = W.partitionBy("length", "cell").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (
        all_pieces.join(starts.drop("n"), ["length", "cell"])
        .withColumn("rank", F.col("first_rank") + F.row_number().over(within) - 1)
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank", "ids")
    )

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, ranks = batch.column(2).to_numpy(), batch.column(5).to_numpy()
        sequence, offset = np.empty(len(ranks), dtype="int64"), np.empty(len(ranks), dtype="int64")
        for size in np.unique(sizes):
            here, table = sizes == size, runs.value[int(size)]
            run = np.searchsorted(table["rank"], ranks[here], side="right") - 1
            sequence[here] = table["sequence"][run] + ranks[here] - table["rank"][run]
            offset[here] = table["offset"][run]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        return pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset), batch.column(6)], names=names)

    columns = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    return arrow_pass(ranked, convert, columns)


def packing_digest(docs: DataFrame, path: str, **options) -> DataFrame:
    """The pieces with a checksum of the ids that they carry in place of these."""
    columns = ["doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"]
    return pack_documents(docs, path, **options).select(*columns)


def sequences(packed: DataFrame) -> DataFrame:
    """Assembles what `pack_documents` placed, a row for each sequence: sequence_id, ids (the pieces' ids one after the
    other, as in `pieces`) and pieces, an array of (offset, length, doc_id, start) by offset.

    A sequence's pieces hold `length` ids at most, so a group is small whatever the data."""
    placed = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "start", "ids")))
    rows = packed.groupBy("sequence_id").agg(placed.alias("placed"))
    # Bytes are joined as hexadecimal digits, in one go for all pieces.
    ids = F.unhex(F.array_join(F.transform("placed", lambda p: F.hex(p["ids"])), ""))
    parts = F.transform("placed", lambda p: F.struct(p["offset"], p["length"], p["doc_id"], p["start"]))
    return rows.select("sequence_id", ids.alias("ids"), parts.cast("array<struct<offset:long,length:long,doc_id:long,start:long>>").alias("pieces"))
