"""Benchmark decontamination: one Aho-Corasick automaton over the items' windows scans every text once.

Items and texts are normalised alike: A-Z lower-cased, words of digits, letters and non-ASCII characters, one space
between words.  A window is ten consecutive words of an item, or the whole item if it is shorter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilayer.llm.common import arrow_pass, id_and_text, plain_words, texts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Bytes of item text that one automaton is built over.  More items take further passes.
AUTOMATON_BYTES = 4 << 20

Items = list[tuple[str, str]]
_AUTOMATA: dict[str, Windows] = {}


class Windows:
    """The automaton over the windows of some items: (item id as string, text)."""

    def __init__(self, items: Items, size: int):
        holders: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            words = plain_words(text)
            for at in range(max(len(words) - size, 0) + 1 if words else 0):
                holders.setdefault(tuple(words[at : at + size]), set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for words, ids in holders.items():
            # Spaces at both ends, so that a hit starts and ends at whole words.
            self.automaton.add_word(f" {b' '.join(words).decode()} ", (len(words), ids))
        self.any = bool(holders)
        if self.any:
            self.automaton.make_automaton()

    def hits(self, text: str) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, merged runs of hit words (first, end), items with a window in the text."""
        words = plain_words(text)
        if not words or not self.any:
            return len(words), [], set()
        line = f" {b' '.join(words).decode()} "
        found = list(self.automaton.iter(line))
        if not found:
            return len(words), [], set()
        spaces = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), dtype="<u4") == 32)
        ends = np.searchsorted(spaces, [at for at, _ in found])
        runs = [(int(end) - n, int(end)) for end, (_, (n, _)) in zip(ends, found)]
        return len(words), merged(runs), set().union(*(holders for _, (_, holders) in found))


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs (first, end) that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


def _windows(items: Items, size: int) -> Windows:
    """Built once in each worker."""
    name = hashlib.sha256(repr((size, items)).encode()).hexdigest()
    if name not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[name] = Windows(items, size)
    return _AUTOMATA[name]


def item_blocks(items: DataFrame, most: int = AUTOMATON_BYTES) -> list[Items]:
    """The items in blocks of `most` bytes: a block is read from its partitions one at a time, never all items at once."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where("item_id is not null and text is not null").distinct().orderBy("item_id", "text")
    blocks, size = [[]], 0
    for row in rows.toLocalIterator():
        if size and size + len(row["text"].encode()) > most:
            blocks.append([])
            size = 0
        blocks[-1].append((row["item_id"], row["text"]))
        size += len(row["text"].encode())
    return blocks


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as code points of the text, ends exclusive."""
    if not runs:
        return []
    places = [m.span() for m in WORD.finditer(text)]
    return [(places[first][0], places[end - 1][1]) for first, end in runs]


def find_contamination(docs: DataFrame, items: DataFrame, size: int = 10, most: int = AUTOMATON_BYTES) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (code points, end exclusive).

    A null or empty text has no words; null items and items without words have no windows; an item id with several texts
    is one item with all their windows.  Rows that repeat are searched one by one.
    """
    rows = id_and_text(docs).withColumns({"runs": F.expr("cast(array() as array<array<long>>)"), "items": F.expr("cast(array() as array<string>)")})
    *earlier, last = [docs.sparkSession.sparkContext.broadcast(block) for block in item_blocks(items, most)]

    def scanned(batch: pa.RecordBatch, shared) -> Iterator[tuple[str, int, list[tuple[int, int]], list[str]]]:
        windows = _windows(shared.value, size)
        for text, old_runs, old_ids in zip(texts(batch), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            n, runs, ids = windows.hits(text)
            yield text, n, merged([*map(tuple, old_runs), *runs]), sorted({*old_ids, *ids})

    for shared in earlier:

        def scan(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            found = list(scanned(batch, shared))
            runs = pa.array([[list(run) for run in runs] for *_, runs, _ in found], pa.list_(pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays([*batch.columns[:2], runs, pa.array([ids for *_, ids in found], pa.list_(pa.string()))], names=["doc_id", "text", "runs", "items"])

        rows = arrow_pass(rows, scan, "doc_id long, text string, runs array<array<long>>, items array<string>")

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, n, runs, ids in scanned(batch, last):
            spans = [{"start": a, "end": b} for a, b in original_spans(text, runs)]
            out.append((n, sum(b - a for a, b in runs), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(runs), spans))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"])

    return arrow_pass(rows, digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<start:long,end:long>>")


def clean_documents(docs: DataFrame, items: DataFrame, size: int = 10, most: int = AUTOMATON_BYTES) -> DataFrame:
    """The rows of `docs` without any window of any item, all columns."""
    plain = docs.withColumn("text", F.col("text").cast("string"))
    for block in item_blocks(items, most):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def scan(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            windows = _windows(shared.value, size)
            return batch.filter(pa.array([not windows.hits(text)[1] for text in texts(batch)], pa.bool_()))

        plain = arrow_pass(plain, scan, plain.schema)
    return plain
