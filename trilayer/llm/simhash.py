"""SimHash near-duplicates by multi-index hashing.

A fingerprint of 64 bits is cut into two segments of 32.  Two fingerprints at most 3 bits apart agree in one segment but
for one bit at most.  So the table files every distinct fingerprint under both segments, queries enumerate the Hamming
ball of radius 1 around each segment, and whatever meets under a value is compared over all 64 bits.  Of the ball only the
value itself and those with one more bit set are asked for: of two segments that differ in one bit, just one asks, so each
pair meets in one direction.

A value where many fingerprints meet is not expanded into pairs.  A task links what it holds into trees, which have the
same components as all pairs; values with more than `block` rows are dealt out as pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trilayer.llm.common import arrow_pass, free_name, id_and_text, same, stored, text_hash, texts
from trilayer.llm.components import connected_components

BITS, SEGMENT_BITS, SEED = 64, 32, 42
#: Votes are summed over so many times 255 shingles at a time.
VOTE_ROWS = 1 << 8


def fingerprint(text: str, shingle: int = 3) -> int:
    """A-Z lower-cased, words split at ASCII white space, shingles with repeats; a bit is 1 if set in over half of them.

    Fewer words than a shingle make one shingle, no words the fingerprint zero.  (`bytes.lower` and `bytes.split` know
    ASCII only, which is what the rule says.)
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends.tolist()[shingle - 1 :] or [len(line)]
    hash_of = xxhash.xxh64_intdigest
    hashes = np.array([hash_of(line[s:e], SEED) for s, e in zip(starts, ends)], dtype="<u8")
    votes = np.zeros(BITS, dtype="int64")
    for at in range(0, len(hashes), VOTE_ROWS * 255):
        part = hashes[at : at + VOTE_ROWS * 255]
        part = np.concatenate((part, np.zeros(-len(part) % 255, dtype="<u8")))
        bits = np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little")
        # Sums of 255 rows fit in a byte.
        votes += bits.reshape(-1, 255, BITS).sum(axis=1, dtype="u1").sum(axis=0, dtype="int64")
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, text_hash and `print` as a signed 64-bit number, for every row."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(text, shingle) for text in texts(batch)], dtype="u8").view("i8")
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(prints)], names=["doc_id", "text_hash", "print"])

    keyed = id_and_text(docs).withColumn("text_hash", text_hash(F.col("text")))
    return arrow_pass(keyed, convert, "doc_id long, text_hash long, print long")


def _probes(prints: DataFrame) -> DataFrame:
    """Rows (segment, value, print, filed): each print once per segment as the table's row, else as a query's."""
    low = F.col("print").bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))
    high = F.shiftrightunsigned("print", SEGMENT_BITS)

    masks = F.array(F.lit(0).cast("long"), *[F.lit(1 << bit).cast("long") for bit in range(SEGMENT_BITS)])

    def ball(value: Column, segment: int) -> Column:
        unset = F.filter(masks, lambda m: value.bitwiseAND(m) == 0)
        return F.transform(unset, lambda m: F.struct(F.lit(segment).alias("segment"), value.bitwiseOR(m).alias("value"), (m == 0).alias("filed")))

    balls = F.concat(ball(high, 0), ball(low, 1))
    return prints.select("print", F.explode(balls).alias("at")).select("at.segment", "at.value", "at.filed", "print")


def forest(prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links between prints at most `max_bits` apart that join what such links join, a tree for each component."""
    links, waiting = [], prints
    while len(waiting):
        front, waiting = [waiting[0]], waiting[1:]
        while front and len(waiting):
            at = front.pop()
            near = np.bitwise_count(waiting ^ at) <= max_bits
            if near.any():
                found = waiting[near]
                waiting = waiting[~near]
                links += [(at, x) for x in found]
                front += list(found)
    return links


def _links_of_groups(rows: DataFrame, max_bits: int) -> DataFrame:
    """Rows arrive sorted by `group`; a group is bounded by twice the block size and may span two batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def linked(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            links = []
            for part in np.split(prints, edges):
                if len(part) == 2:
                    if int(part[0] ^ part[1]).bit_count() <= max_bits:
                        links.append((part[0], part[1]))
                else:
                    links += forest(np.unique(part), max_bits)
            pairs = np.array(links, dtype="u8").reshape(-1, 2).view("i8")
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

        keys, prints = np.empty((0, 4), dtype="i8"), np.empty(0, dtype="u8")
        for batch in batches:
            keys = np.concatenate((keys, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:4]], axis=1)))
            prints = np.concatenate((prints, batch.column(4).to_numpy().view("u8")))
            # The last group may go on.
            ended = int(np.flatnonzero((keys == keys[-1]).all(axis=1))[0]) if len(keys) else 0
            if ended:
                yield linked(keys[:ended], prints[:ended])
                keys, prints = keys[ended:], prints[ended:]
        if len(keys):
            yield linked(keys, prints)

    return rows.mapInArrow(run, "a long, b long")


def linked_prints(prints: DataFrame, max_bits: int = 3, block: int = 1024) -> DataFrame:
    """Links (a, b) between distinct prints at most `max_bits` apart, enough of them to join what all of them join."""
    if max_bits > 3:
        raise ValueError("two segments with balls of radius 1 find distances up to 3")
    here = W.partitionBy("segment", "value")
    met = (
        _probes(prints)
        .withColumn("n", F.count("*").over(here))
        .withColumn("filed_here", F.max("filed").over(here))
        .where("n > 1 and filed_here")
        .withColumn("place", F.row_number().over(here.orderBy("print")) - 1)
    )
    # Block i meets block j for all i <= j; a row of block i goes to the groups (i, j) and (j, i).
    blocks = F.ceil(F.col("n") / block).cast("long")
    own = (F.col("place") % blocks).cast("long")
    others = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    group = ["segment", "value", "i", "j"]
    rows = met.select(F.col("segment").cast("long").alias("segment"), "value", F.explode(others).alias("pair"), "print")
    rows = rows.select("segment", "value", "pair.i", "pair.j", "print").repartition(*group).sortWithinPartitions(*group)
    return _links_of_groups(rows, max_bits).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, block: int = 1024) -> DataFrame:
    """Per row of `docs`: doc_id, text_hash, print, root (names the component), component_id (the smallest doc_id reachable
    over links).

    Rows with equal prints are one component, also those without words (print zero).  A null text has no words; null ids
    do not name a component unless all its ids are null, then component_id is null.  Rows that share an id count apart.
    """
    marked = stored(fingerprints(docs, shingle))
    prints = stored(marked.groupBy("print").agg(F.min("doc_id").alias("least_id")))
    links = stored(linked_prints(prints.select("print"), max_bits, block))
    roots = connected_components(links)
    joined = prints.join(roots, prints["print"] == roots["node"], "left").select("print", "least_id", F.coalesce("root", "print").alias("root"))
    least = joined.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_print = stored(joined.join(least, "root").select("print", "root", "component_id"))
    return marked.join(of_print, "print").select("doc_id", "text_hash", "print", "root", "component_id")


def near_duplicate_digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id."""
    found = near_duplicates(docs, **options)
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One row of `docs` for each component, one with its smallest doc_id, all columns.

    Of several such rows (repeated ids, or a component of null ids only) the one with the smallest text hash stays; of rows
    equal in id and text any one stays, whole.
    """
    found = near_duplicates(docs, **options)
    first = found.where(same(F.col("doc_id"), F.col("component_id"))).groupBy("root", "doc_id").agg(F.min("text_hash").alias("text_hash"))
    id_name, hash_name = free_name(docs, "kept_id"), free_name(docs, "kept_hash")
    kept = stored(first.select(F.col("doc_id").alias(f"{id_name}_of"), F.col("text_hash").alias(f"{hash_name}_of")))
    keyed = docs.withColumns({id_name: docs["doc_id"].cast("long"), hash_name: text_hash(docs["text"])})
    # Ids that grow with the data are not broadcast at any size.
    equal = same(F.col(id_name), F.col(f"{id_name}_of")) & (F.col(hash_name) == F.col(f"{hash_name}_of"))
    standing = keyed.join(kept.hint("merge"), equal, "left_semi")
    # Copies meet as one row from each task.
    return standing.dropDuplicates([id_name, hash_name]).drop(id_name, hash_name)
