"""Exact repeated passages by a depth-limited radix sort: suffixes are ordered through `WINDOW` bytes only.

Every window of 200 bytes is the start of a suffix; suffixes equal through 200 bytes are the repeated passages.  Groups of
suffixes are split by one digit after another, and those that are alone in their group leave after each pass:

1. The first digit deals the suffixes out.  It is a piece of 50 bytes and its place in the window; which of its pieces
   stands first is decided by a window's content (the piece that starts at the smallest hash among the first 151 places),
   so equal windows agree on it, and some 75 windows in a row share one: a row for each, its anchor, stands for them all.
   Windows whose digit occurs once in all texts are done, they have no equal.
2. Equal stretches, a stretch being all that an anchor's windows cover, have all windows equal and are not sorted: they are
   found by two 64-bit hashes, of the digit and of the stretch.
3. Of a digit with several stretches, one of each is taken.  Their windows go through most-significant-digit passes from the
   first byte on, eight bytes a pass, until 200 are compared; the groups that are left are equal in all 200 bytes.

Passes 1 and 2 are aggregations and joins of numbers.  Pass 3 sees only stretches at the ends of passages, in batches of
whole digits of bounded size.  A digit with more than `GROUP` stretches is dealt out by window instead: windows that are
alone under a hash of their bytes leave, those left are grouped by the 200 bytes themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilayer.llm.common import arrow_pass, id_and_text, same, stored, text_hash

WINDOW, DIGIT = 200, 50
PLACES = WINDOW - DIGIT + 1
#: Windows that a worker handles at a time, bytes of stretches that it orders at a time, stretches in a group.
CHUNK, ORDER_BYTES, GROUP = 1 << 20, 1 << 20, 4000

_ROLL = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93


def _anchors(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts laid end to end: first window, number of windows and anchor of each run of windows that share it."""
    firsts, counts, anchors = [], [], []
    for at in range(0, max(len(text) - WINDOW + 1, 0), CHUNK):
        n = min(CHUNK, len(text) - WINDOW + 1 - at)
        places = n + PLACES - 1
        # The eight bytes from each place on, as a number; a place's rank is a product of it, ties go to the left.
        rank = np.empty(places + 8, dtype="u8")
        part = text[at : at + places + 16]
        part = np.concatenate((part, np.zeros(places + 16 - len(part), dtype="u1")))
        for shift in range(8):
            eight = part[shift : shift + (places + 8 - shift) // 8 * 8].view("<u8")
            rank[shift::8][: len(eight)] = eight
        rank = ((rank[:places] * _ROLL) & np.uint64(0xFFFFFFFF00000000)) | np.arange(places, dtype="u8")
        rows = np.concatenate((rank, np.full(-places % PLACES, np.iinfo("u8").max, dtype="u8"))).reshape(-1, PLACES)
        before = np.minimum.accumulate(rows, axis=1).ravel()
        after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(after[:n], before[PLACES - 1 : PLACES - 1 + n])
        anchor = (least & np.uint64(0xFFFFFFFF)).astype("i8") + at
        start = np.arange(at, at + n)
        inside = start + WINDOW <= ends[np.searchsorted(ends, start, side="right")]
        anchor[~inside] = -1
        new = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        firsts.append(new + at)
        counts.append(np.diff(np.concatenate((new, [n]))))
        anchors.append(anchor[new])
    if not firsts:
        return (np.empty(0, dtype="i8"),) * 3
    first, count, anchor = map(np.concatenate, (firsts, counts, anchors))
    # A run may go on over the border of two chunks.
    new = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    count = np.add.reduceat(count, new)
    first, anchor = first[new], anchor[new]
    real = anchor >= 0
    return first[real], count[real], anchor[real]


def _signed(numbers: list[int]) -> pa.Array:
    return pa.array(np.array(numbers, dtype="u8").view("i8"))


def anchors(docs: DataFrame) -> DataFrame:
    """A row for each anchor: doc_id, text_hash, first (window), windows, place (of the anchor in the first window), digit,
    stretch."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = pc.fill_null(batch.column(1), "").cast(pa.large_binary())
        bounds = np.frombuffer(column.buffers()[1], dtype="i8")[column.offset : column.offset + len(column) + 1]
        text = np.frombuffer(column.buffers()[2] or b"", dtype="u1")[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        first, count, anchor = _anchors(text, bounds[1:])
        row = np.searchsorted(bounds[1:], first, side="right")
        view = memoryview(text)
        digest = xxhash.xxh3_64_intdigest
        digits = [digest(view[a : a + DIGIT]) for a in anchor.tolist()]
        place = anchor - first
        stretches = [digest(view[f : f + n + WINDOW - 1], p) for f, n, p in zip(first.tolist(), count.tolist(), place.tolist())]
        taken = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(taken), batch.column(2).take(taken), pa.array(first - bounds[:-1][row]), pa.array(count.astype("i4")), pa.array(place.astype("i4")), _signed(digits), _signed(stretches)],
            names=["doc_id", "text_hash", "first", "windows", "place", "digit", "stretch"],
        )

    keyed = id_and_text(docs).withColumn("text_hash", text_hash(F.col("text")))
    return arrow_pass(keyed, convert, "doc_id long, text_hash long, first long, windows int, place int, digit long, stretch long")


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and the text's bytes, compressed for the way through a shuffle."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = [(value.as_py() or "").encode() for value in batch.column(1)]
        packed = pa.array([pa.compress(x, codec="zstd", asbytes=True) for x in raw], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(map(len, raw), pa.int64()), packed], names=["doc_id", "text_hash", "n_bytes", "packed"])

    keyed = id_and_text(docs).withColumn("text_hash", text_hash(F.col("text")))
    return arrow_pass(keyed, convert, "doc_id long, text_hash long, n_bytes long, packed binary")


def _of_document(docs: DataFrame, rows: DataFrame, name: str, kind: str) -> DataFrame:
    """The packed documents with the array `name` of their rows."""
    lists = rows.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct(*[c for c in rows.columns if c not in ("doc_id", "text_hash")])).alias(name))
    other = lists.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), name)
    packed = _packed(docs)
    return packed.join(other, same(packed["doc_id"], other["of_id"]) & same(packed["text_hash"], other["of_hash"]), kind).drop("of_id", "of_hash")


def _bytes(batch: pa.RecordBatch, row: int) -> bytes:
    n = batch.column(2)[row].as_py()
    return pa.decompress(batch.column(3)[row].as_py(), decompressed_size=n, codec="zstd", asbytes=True) if n else b""


def _stretches(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The bytes of chosen stretches."""
    columns = ["digit", "first", "windows", "place", "alone", "members"]

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, fields, parts = [], {name: [] for name in columns}, []
        for i, chosen in enumerate(batch.column(4).to_pylist()):
            text = _bytes(batch, i)
            for one in chosen:
                rows.append(i)
                parts.append(text[one["first"] : one["first"] + one["windows"] + WINDOW - 1])
                for name in columns:
                    fields[name].append(one[name])
        taken = pa.array(rows, pa.int64())
        kinds = {"digit": pa.int64(), "first": pa.int64(), "windows": pa.int32(), "place": pa.int32(), "alone": pa.bool_(), "members": pa.int64()}
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(taken), batch.column(1).take(taken), *[pa.array(fields[n], kinds[n]) for n in columns], pa.array(parts, pa.binary())],
            names=["doc_id", "text_hash", *columns, "bytes"],
        )

    rows = _of_document(docs, chosen, "chosen", "inner")
    return arrow_pass(rows, convert, "doc_id long, text_hash long, digit long, first long, windows int, place int, alone boolean, members long, bytes binary")


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n + 1, _BASE, dtype="u8"), np.full(n + 1, inverse, dtype="u8")
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_LETTERS = np.random.default_rng(20).integers(1, 1 << 64, 256, dtype="u8")


def _windows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the batch's stretches: row, number in the stretch, first byte in `text`; and `text`, the stretches
    laid end to end."""
    parts = batch.column(8).cast(pa.large_binary())
    bounds = np.frombuffer(parts.buffers()[1], dtype="i8")[parts.offset : parts.offset + len(parts) + 1]
    text = np.frombuffer(parts.buffers()[2], dtype="u1")[bounds[0] : bounds[-1]]
    windows = batch.column(4).to_numpy().astype("i8")
    row = np.repeat(np.arange(len(windows)), windows)
    number = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    return row, number, (bounds[:-1] - bounds[0])[row] + number, text


def _window_keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all windows of the batch's stretches: row, number in the stretch, and a hash of (digit, place of the digit in
    the window, all 200 bytes)."""
    row, number, start, text = _windows(batch)
    up, down = _powers(len(text))
    sums = np.concatenate((np.zeros(1, dtype="u8"), np.cumsum(_LETTERS[text] * up[:-1], dtype="u8")))
    key = (sums[start + WINDOW] - sums[start]) * down[start]
    place = batch.column(5).to_numpy().astype("i8")[row] - number
    key = (key ^ (key >> np.uint64(31))) * _ROLL + batch.column(2).to_numpy().view("u8")[row]
    key = (key ^ (key >> np.uint64(29))) * np.uint64(_BASE) + place.astype("u8")
    return row, number, key


def _radix_passes(text: np.ndarray, start: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which of the suffixes that begin at `start` equal another one of their group through `WINDOW` bytes.

    A pass splits each group by the next eight bytes and puts its parts in their order; groups of one leave.  A group in
    which all agree on a digit is passed on as it is.
    """
    text = np.concatenate((text, np.zeros(16, dtype="u1")))
    digits = np.empty(len(text) - 8, dtype="u8")
    for shift in range(8):
        eight = text[shift : shift + (len(text) - shift) // 8 * 8].view(">u8")
        digits[shift::8] = eight[: len(digits[shift::8])]
    left = np.argsort(group)
    group = group[left]
    # `new`: where a group begins among those left.
    new = np.concatenate((np.ones(min(len(group), 1), dtype=bool), group[1:] != group[:-1]))
    for depth in range(0, WINDOW, 8):
        several = _several(new)
        new, left = new[several], left[several]
        new, left = _split(new, left, digits[start[left] + depth])
    return left[_several(new)]


def _several(new: np.ndarray) -> np.ndarray:
    """Which members have a group of two or more, by where groups begin."""
    return ~(new & np.concatenate((new[1:], np.ones(min(len(new), 1), dtype=bool))))


def _split(new: np.ndarray, left: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups split by a digit: where the new groups begin, and their members in order."""
    differs = np.concatenate((np.zeros(min(len(digit), 1), dtype=bool), digit[1:] != digit[:-1])) & ~new
    if not differs.any():
        return new, left
    number = np.cumsum(new) - 1
    mixed = np.zeros(number[-1] + 1, dtype=bool)
    mixed[number[differs]] = True
    at = np.flatnonzero(mixed[number])
    order = at[np.lexsort((digit[at], number[at]))]
    left, digit = left.copy(), digit.copy()
    left[at], digit[at] = left[order], digit[order]
    return new | np.concatenate((np.zeros(1, dtype=bool), digit[1:] != digit[:-1])), left


def _runs(batch: pa.RecordBatch, row: np.ndarray, number: np.ndarray) -> pa.RecordBatch:
    """Marked windows as rows (doc_id, text_hash, first, windows), consecutive ones as one."""
    new = np.flatnonzero(np.concatenate((np.ones(min(len(row), 1), dtype=bool), (row[1:] != row[:-1]) | (number[1:] != number[:-1] + 1))))
    count = np.diff(np.concatenate((new, [len(row)])))
    taken = pa.array(row[new])
    first = batch.column(3).to_numpy()[row[new]] + number[new]
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(first), pa.array(count.astype("i4"))], names=["doc_id", "text_hash", "first", "windows"]
    )


def _order_groups(rows: DataFrame) -> DataFrame:
    """Rows come sorted by digit; a group, at most `GROUP` stretches, is ordered at once."""

    def ordered(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, number, start, text = _windows(batch)
        digit = batch.column(2).to_numpy()
        nth = np.cumsum(np.concatenate(([False], digit[1:] != digit[:-1])))
        place = batch.column(5).to_numpy().astype("i8")[row] - number
        marked = np.sort(_radix_passes(text, start, nth[row] * WINDOW + place))
        marked = marked[batch.column(6).to_numpy(zero_copy_only=False)[row[marked]]]
        return _runs(batch, row[marked], number[marked])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.RecordBatch | None = None
        for batch in batches:
            waiting = batch if waiting is None else pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()[0] if batch.num_rows else waiting
            if not waiting.num_rows:
                continue
            digit = waiting.column(2).to_numpy()
            ends = np.flatnonzero(digit[1:] != digit[:-1]) + 1
            sizes = np.cumsum(pc.binary_length(waiting.column(8)).to_numpy())
            done = 0
            for end in ends:
                if sizes[end - 1] - (sizes[done - 1] if done else 0) >= ORDER_BYTES or end == ends[-1]:
                    yield ordered(waiting.slice(done, end - done))
                    done = int(end)
            waiting = waiting.slice(done)
        if waiting is not None and waiting.num_rows:
            yield ordered(waiting)

    return rows.mapInArrow(run, "doc_id long, text_hash long, first long, windows int")


def _order_windows(rows: DataFrame) -> DataFrame:
    """The same for groups of any size, by aggregations over windows."""
    ids = "doc_id long, text_hash long, first long"

    def explode(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, number, key = _window_keys(batch)
        taken = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(taken), batch.column(1).take(taken), batch.column(3).take(taken), pa.array(number.astype("i4")), pa.array(key.view("i8"))],
            names=["doc_id", "text_hash", "first", "number", "key"],
        )

    def spell(batch: pa.RecordBatch) -> pa.RecordBatch:
        taken, first, spelt = [], [], []
        for i, numbers in enumerate(batch.column(5).to_pylist()):
            text, at = batch.column(4)[i].as_py(), batch.column(2)[i].as_py()
            for number in numbers:
                taken.append(i)
                first.append(at + number)
                spelt.append(text[number : number + WINDOW])
        row = pa.array(taken, pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(row), batch.column(1).take(row), pa.array(first, pa.int64()), batch.column(3).take(row), pa.array(spelt, pa.binary())],
            names=["doc_id", "text_hash", "first", "alone", "window"],
        )

    def by_pieces(convert, n):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, n):
                    yield convert(batch.slice(at, n))

        return run

    windows = stored(rows.mapInArrow(by_pieces(explode, GROUP), f"{ids}, number int, key long"))
    named = stored(windows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    # A stretch has no more than PLACES windows, so these lists are short.
    left = windows.join(named, "key", "left_semi").groupBy("doc_id", "text_hash", "first").agg(F.collect_list("number").alias("numbers"))
    left = left.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), F.col("first").alias("of_first"), "numbers")
    match = same(rows["doc_id"], left["of_id"]) & same(rows["text_hash"], left["of_hash"]) & (rows["first"] == left["of_first"])
    spelt = stored(rows.join(left, match).select("doc_id", "text_hash", "first", "alone", "bytes", "numbers").mapInArrow(by_pieces(spell, 256), f"{ids}, alone boolean, window binary"))
    repeated = spelt.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    return spelt.where("alone").join(repeated, "window", "left_semi").select("doc_id", "text_hash", "first", F.lit(1).alias("windows"))


def repeated_windows(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """Runs of windows that start anywhere else too: doc_id, text_hash, first (byte), windows."""
    rows = stored(anchors(docs))
    digits = stored(rows.groupBy("digit").agg(F.count("*").alias("n")).where("n > 1").select("digit"))
    rows = stored(rows.join(digits, "digit", "left_semi"))
    one = F.min(F.struct("doc_id", "text_hash", "first", "windows", "place")).alias("one")
    stretches = stored(rows.groupBy("digit", "stretch").agg(F.count("*").alias("n"), one))
    several = stored(
        stretches.groupBy("digit").agg(F.count("*").alias("members"), F.min("n").alias("least")).where("members > 1 and least = 1").select("digit", "members")
    )
    whole = rows.join(stretches.where("n > 1").select("digit", "stretch"), ["digit", "stretch"], "left_semi")
    chosen = stretches.join(several, "digit").select("one.doc_id", "one.text_hash", "digit", "one.first", "one.windows", "one.place", (F.col("n") == 1).alias("alone"), "members")
    parts = stored(_stretches(docs, chosen))
    found = whole.select("doc_id", "text_hash", "first", "windows").unionByName(
        _order_groups(parts.where(F.col("members") <= group).repartition("digit").sortWithinPartitions("digit"))
    )
    if several.where(F.col("members") > group).limit(1).count():
        found = found.unionByName(_order_windows(parts.where(F.col("members") > group)))
    return found


def without_repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """Per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and `kept`, the bytes that are left.

    Texts are UTF-8 bytes, a null text is empty, and cuts may fall within a character.  Every byte that a repeated window
    covers goes, in all its places; rows that repeat are documents of their own, so they lose all of 200 bytes or more.
    """

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        removed, spans, digests, kept = [], [], [], []
        for i, found in enumerate(batch.column(4).to_pylist()):
            text, parts, done, n_spans = _bytes(batch, i), [], 0, 0
            for first, end in sorted((one["first"], one["first"] + one["windows"] + WINDOW - 1) for one in found or ()):
                if first > done or not n_spans:
                    parts.append(text[done:first])
                    n_spans += 1
                done = max(done, end)
            parts.append(text[done:])
            left = b"".join(parts)
            removed.append(len(text) - len(left))
            spans.append(n_spans)
            digests.append(hashlib.sha256(left).hexdigest())
            kept.append(left)
        numbers = [pa.array(x, pa.int64()) for x in (removed, spans)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), *numbers, pa.array(digests, pa.string()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )

    rows = _of_document(docs, repeated_windows(docs, group), "found", "left")
    return arrow_pass(rows, convert, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
