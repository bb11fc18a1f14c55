"""Language-model scores: a Katz backoff model of bigrams, trained and applied in one set of passes.

Counts are Good-Turing discounted.  A seen bigram has its discounted share of its context; what the discounts leave goes to
the unseen words of the context, in proportion to their unigram probability and exactly normalised, and an unseen word
of the corpus takes what the unigram discounts leave.  Probabilities are evaluated from the bigram down: bigram, else backoff
weight times unigram, else the unknown word.

1. Words are counted and stored as a table, exact, by the word itself.  From then on a word has a key: its rank, if it is one
   of the `FREQUENT` most frequent, else a hash as short as the number of words allows; that no two words share one is
   checked, and another salt is taken where two do.
2. Documents are tokenised in blocks.  A block's bigrams, with the documents that hold them, go to buckets by
   context, packed in one row for each block and bucket, into a table bucketed by that number.  A context that
   makes 1/`HOT_SHARE` or more of all training tokens is spread over all buckets; there are at most `HOT_SHARE` of these and the start.
3. A pass over the buckets merges the counts: counts of counts, and which words a bucket needs the unigram count of.
4. A second pass, with these counts, discounts, weighs and looks up, and sums for the documents of each block, a row for each
   bucket and block.  The rows of a block, no more numbers than its text has tokens, are added up last, with the weights
   of spread contexts.

Every count covers all training rows.  A null text is empty (its end is still a token), a null id counts as the empty text in the choice of held-out rows,
repeated rows are counted and scored one by one.  Without training rows every word is unknown, with probability one.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.llm.common import shared_folder, stored, texts

#: What stands before the first word, and after the last.  No word is empty or holds a space.
START, END = b" ", b""
#: Greatest count that is discounted.
KATZ = 5
#: What is left to unseen words where no count of a context is discounted, in tokens.
LEAST_LEFT = 0.5
#: A spread context has this part of all training tokens at least.
HOT_SHARE = 1024
#: Training tokens for each bucket, bytes of text and documents in a block.
BUCKET_TOKENS, BLOCK_BYTES, BLOCK_DOCS = 2_500_000, 3 << 20, 1 << 20
#: An odd number without a short pattern.
SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Words with a rank for a key.
FREQUENT = 1 << 15
#: Files that tasks may write straight into the buckets; where it would be more, rows are dealt by bucket first.
MAX_FILES = 20_000
PACKED = "bucket int, block long, sizes array<int>, raw long, packed binary, ids array<long>, held array<boolean>, tokens array<long>"


def words_of(text: str) -> list[bytes]:
    """The words `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased; bytes split and lower-case by ASCII only."""
    return text.encode().lower().split()


def discounts(counts: list[int]) -> np.ndarray:
    """Katz's ratios for the counts 0 to `KATZ`, from the numbers of types that occur 1 to `KATZ` + 1 times.  A ratio that these
    leave undefined or outside (0, 1) is that of half a token taken off."""
    found = np.zeros(KATZ + 1)
    common = (KATZ + 1) * counts[KATZ] / counts[0] if counts[0] else 1.0
    for r in range(1, KATZ + 1):
        ratio = ((r + 1) * counts[r] / (r * counts[r - 1]) - common) / (1 - common) if counts[r - 1] and common < 1 else 0.0
        found[r] = ratio if 0 < ratio < 1 else (r - 0.5) / r
    return found


def discounted(counts: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= KATZ, ratios[np.minimum(counts, KATZ)], 1.0)


@dataclass(frozen=True)
class Unigrams:
    """Discounted probabilities of words by count; `tokens` and `types` are of the training rows."""

    tokens: int
    types: int
    ratios: np.ndarray
    mass: float
    unseen: float

    @staticmethod
    def of(tokens: int, types: int, counts: list[int]) -> Unigrams:
        ratios = discounts(counts)
        kept = tokens - sum(n * r * (1 - ratios[r]) for r, n in enumerate(counts[:KATZ], 1))
        mass = max(tokens, kept + LEAST_LEFT)
        return Unigrams(tokens, types, ratios, mass, 1 - kept / mass)

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.ratios) / self.mass, self.unseen)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of at most `BLOCK_BYTES` of text, or of one text, with their texts."""
    for batch in batches:
        low, size, held = 0, 0, []
        for i, text in enumerate(texts(batch)):
            if held and (size + len(text) > BLOCK_BYTES or len(held) == BLOCK_DOCS):
                yield batch.slice(low, i - low), held
                low, size, held = i, 0, []
            held.append(text)
            size += len(text)
        if held:
            yield batch.slice(low), held


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n) of all rows, n in the training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, held in _blocks(batches):
            trained, other = Counter(), set()
            for text, out in zip(held, batch.column(2).to_pylist()):
                words = words_of(text)
                if out:
                    other.update(words)
                    other.add(END)
                else:
                    trained.update(words)
                    trained[END] += 1
            # The start has a key too, and is no word.
            found = [*trained, *(other - trained.keys()), START]
            columns = [pa.array(found, pa.binary()).cast(pa.string()), pa.array([trained[w] for w in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "n"])
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Keys:
    """Keys of words: the rank of a frequent word, else the low bits of a salted hash below a bit that no rank has."""

    salt: str
    bits: int
    ranks: dict[bytes, int]

    def of(self, words: Iterable[bytes]) -> np.ndarray:
        salt, mask, mark, ranks = self.salt.encode(), (1 << self.bits) - 1, 1 << self.bits, self.ranks
        rank, digest = ranks.get, xxhash.xxh64_intdigest
        return np.array([digest(salt + w, 42) & mask | mark if (found := rank(w)) is None else found for w in words], "u8")

    @staticmethod
    def apart(words: DataFrame) -> tuple[Keys, DataFrame]:
        """Keys that tell all of `words` (word, n) apart, and the words with their `key`.  At most `FREQUENT` words, the most
        frequent ones, pass the driver."""
        often = words.orderBy(F.desc("n"), "word").limit(FREQUENT).select("word").collect()
        ranks = {r["word"]: i for i, r in enumerate(often)}
        ranked = words.sparkSession.createDataFrame(list(ranks.items()), "word string, rank long")
        ranked = stored(words.join(ranked, "word", "left"))
        bits = min(62, 8 * math.ceil((2 * math.log2(max(words.count(), 2)) + 4) / 8))
        for salt in map(str, itertools.count()):
            hashed = F.xxhash64(F.concat(F.lit(salt), F.col("word"))).bitwiseAND(F.lit((1 << bits) - 1)).bitwiseOR(F.lit(1 << bits))
            keyed = ranked.select("word", "n", F.coalesce("rank", hashed).alias("key"))
            if not keyed.where("rank is null").groupBy("key").count().where("count > 1").limit(1).count():
                return Keys(salt, bits, {w.encode(): i for w, i in ranks.items()}), keyed


def _planes(values: np.ndarray) -> bytes:
    """The bytes of whole numbers, all first bytes first: small numbers leave runs of zeros."""
    return values.view("u1").reshape(-1, values.itemsize).T.tobytes()


def pack(arrays: list[np.ndarray]) -> tuple[list[int], int, bytes]:
    """Arrays, the first of unsigned 64-bit and the others of 32-bit numbers, as lengths, bytes, and compressed bytes.  The first
    two rise, so their steps are kept."""
    steps = [np.diff(a, prepend=a.dtype.type(0)) if i < 2 else a for i, a in enumerate(arrays)]
    raw = b"".join(map(_planes, steps))
    return [len(a) for a in arrays], len(raw), pa.compress(raw, "zstd", asbytes=True)


def unpack(sizes: list[int], raw: int, packed: bytes) -> list[np.ndarray]:
    data, arrays, at = np.frombuffer(pa.decompress(packed, raw, "zstd"), "u1"), [], 0
    for i, size in enumerate(sizes):
        width = 4 if i else 8
        planes = data[at : at + size * width].reshape(width, size)
        values = np.ascontiguousarray(planes.T).view("u4" if i else "u8").ravel()
        arrays.append(np.cumsum(values, dtype=values.dtype) if i < 2 else values)
        at += size * width
    return arrays


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[i] .. starts[i] + sizes[i] - 1 of all i, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def block_rows(held: list[str], out: list[bool], word_keys: Keys, hot: np.ndarray, buckets: int, tokens: list[int]) -> Iterator[tuple[int, list[int], int, bytes]]:
    """For each bucket with a bigram of these texts: its number and, packed, the keys of its words, both words of each bigram
    as places among these, the number of its documents, these documents, the times it occurs in each, and the training documents
    of the block as 0 or 1.  `tokens` gets the number of each text's tokens."""
    index: defaultdict[bytes, int] = defaultdict()
    index.default_factory = index.__len__
    lengths, flat = np.empty(len(held), "i4"), []
    for i, text in enumerate(held):
        words = words_of(text)
        lengths[i] = len(words) + 1
        flat.append(np.fromiter(map(index.__getitem__, itertools.chain((START,), words, (END,))), "i4", len(words) + 2))
    tokens += lengths.tolist()
    # Numbered by key, so that sorted bigrams are sorted by the keys of their words.
    keys = word_keys.of(index)
    by_key = np.argsort(keys)
    rank = np.empty(len(keys), "i4")
    rank[by_key] = np.arange(len(keys), dtype="i4")
    keys, at = keys[by_key], rank[np.concatenate(flat)]
    n_words = len(keys)
    del index, flat, rank, by_key
    first = np.ones(len(at), bool)
    first[np.cumsum(lengths + 1) - 1] = False
    left = np.flatnonzero(first)
    pair = at[left] * np.int64(n_words) + at[left + 1]
    doc = np.repeat(np.arange(len(held), dtype="i4"), lengths)
    del at, left, first
    order = np.argsort(pair, kind="stable")
    pair, doc = pair[order], doc[order]
    del order
    new_pair = np.concatenate([[True], pair[1:] != pair[:-1]])
    entry = np.flatnonzero(new_pair | np.concatenate([[True], doc[1:] != doc[:-1]]))
    times, doc = np.diff(np.append(entry, len(pair))), doc[entry]
    head = np.flatnonzero(new_pair[entry])
    in_docs = np.diff(np.append(head, len(entry)))
    one, two = np.divmod(pair[entry[head]], n_words)
    spread = np.isin(keys, hot)[one]
    # Ranks lie close together, so the sum is spread by a multiplication first.
    bucket = (((keys[one] + np.where(spread, keys[two], np.uint64(0))) * SPREAD >> np.uint64(32)) % np.uint64(buckets)).astype("i8")
    by_bucket = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
    trained = np.array([not o for o in out], "u4")
    for b in range(buckets):
        mine = by_bucket[bounds[b] : bounds[b + 1]]
        if len(mine):
            entries = _runs(head[mine], in_docs[mine])
            left, right = one[mine], two[mine]
            # Words are numbered by key, so marking the used ones sorts them.
            used = np.zeros(n_words, bool)
            used[left] = used[right] = True
            place = np.cumsum(used, dtype="u4") - np.uint32(1)
            yield b, *pack([keys[used], place[left], place[right], *(a.astype("u4") for a in (in_docs[mine], doc[entries], times[entries])), trained])


def packed_bigrams(rows: DataFrame, word_keys: Keys, hot: list[int], buckets: int) -> DataFrame:
    """The bucketed table of bigrams, with a row for each block and bucket.  Rows with a negative bucket have the
    documents of a block instead: ids, held out or not, tokens."""
    hot_keys = np.array(hot, "i8").view("u8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("sizes", pa.list_(pa.int32())), ("raw", pa.int64()), ("packed", pa.binary()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("tokens", pa.list_(pa.int64()))])
        task = TaskContext.get().partitionId()
        for number, (batch, held) in enumerate(_blocks(batches)):
            # A block's first row number: blocks of a task and rows of a block have 20 bits each.
            block, out = (task << 40) | (number << 20), batch.column(2).to_pylist()
            tokens: list[int] = []
            found = [(b, block, sizes, raw, packed, None, None, None) for b, sizes, raw, packed in block_rows(held, out, word_keys, hot_keys, buckets, tokens)]
            found.append((-1 - (task + number) % buckets, block, None, None, None, batch.column(0).to_pylist(), out, tokens))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)
            pa.default_memory_pool().release_unused()

    spark = rows.sparkSession
    name, folder = f"bigrams_{uuid.uuid4().hex}", shared_folder(spark)
    packed = rows.mapInArrow(run, PACKED)
    if rows.rdd.getNumPartitions() * buckets > MAX_FILES:
        packed = packed.repartition(buckets, "bucket")
    packed.write.bucketBy(buckets, "bucket").option("path", folder).format("parquet").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"drop table {name}")
    return table


class Bucket:
    """The bigrams of a bucket, merged: `words` keys, `one` and `two` places among these, `counts` in training rows."""

    def __init__(self, rows: pa.Table):
        blocks = [(r["block"], *unpack(r["sizes"], r["raw"], r["packed"])) for r in rows.select(["block", "sizes", "raw", "packed"]).to_pylist()]
        self.words = np.unique(np.concatenate([b[1] for b in blocks]))
        n = len(self.words)
        keys, counts = [], []
        #: Of each block: its number, documents per bigram, documents, times, number of documents.
        self.blocks = []
        while blocks:
            block, words, one, two, in_docs, doc, times, trained = blocks.pop()
            place = np.searchsorted(self.words, words)
            keys.append(place[one] * n + place[two])
            counts.append(np.add.reduceat(times.astype("i8") * trained[doc], np.cumsum(in_docs, dtype="i8") - in_docs))
            self.blocks.append((block, in_docs, doc, times, len(trained)))
        keys = np.concatenate(keys)
        order = np.argsort(keys)
        keys = keys[order]
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        #: The bigram of each block's bigrams.
        self.inverse = np.empty(len(keys), "i4")
        self.inverse[order] = np.cumsum(new, dtype="i4") - np.int32(1)
        del order
        self.counts = np.bincount(self.inverse, np.concatenate(counts)).astype("i8")
        self.one, self.two = (p.astype("i4") for p in np.divmod(keys[new], n))
        del keys, new, counts
        #: Places where a context's bigrams start, and the context of each bigram.
        self.starts = np.flatnonzero(np.concatenate([[True], self.one[1:] != self.one[:-1]]))
        self.context = np.repeat(np.arange(len(self.starts), dtype="i4"), np.diff(np.append(self.starts, len(self.one))))

    def by_context(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts)

    def hot_places(self, hot: np.ndarray) -> np.ndarray:
        """For each context its place among the sorted `hot` keys, or -1."""
        keys = self.words[self.one[self.starts]]
        at = np.searchsorted(hot, keys)
        return np.where(np.append(hot, 0)[at] == keys, at, -1) if len(hot) else np.full(len(keys), -1)


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array([values.astype("u8").view("i8") if values.dtype == np.uint64 else values.astype("i8")], pa.list_(pa.int64()))


def bucket_counts(packed: DataFrame, hot: np.ndarray) -> DataFrame:
    """Per bucket: second words, counts of counts, and of each spread context here its place, tokens, and the
    types that occur 1 to `KATZ` times."""

    def run(rows: pa.Table) -> pa.Table:
        found = Bucket(rows)
        at = found.hot_places(hot)
        there = at >= 0
        few = np.stack([found.by_context((found.counts == r).astype("i8")) for r in range(1, KATZ + 1)], axis=1)[there]
        counts = np.array([(found.counts == r).sum() for r in range(1, KATZ + 2)])
        columns = [pa.array([rows.column("bucket")[0].as_py()], pa.int32()), _longs(found.words[np.unique(found.two)]), _longs(counts), _longs(at[there]), _longs(found.by_context(found.counts)[there]), _longs(few.ravel())]
        return pa.Table.from_arrays(columns, names=["bucket", "words", "counts", "hot", "hot_tokens", "hot_few"])

    shape = "bucket int, words array<long>, counts array<long>, hot array<long>, hot_tokens array<long>, hot_few array<long>"
    return packed.where("bucket >= 0").groupBy("bucket").applyInArrow(run, shape)


#: Arrays of a row of sums.
PART_ARRAYS = {
    "doc": pa.int32(), "base": pa.float64(), "known": pa.int64(), "score": pa.float64(), "late_doc": pa.int32(), "late_hot": pa.int32(),
    "late_times": pa.int64(), "hot": pa.int32(), "seen": pa.float64(),
}


def bucket_scores(packed: DataFrame, known: DataFrame, unigrams: Unigrams, ratios: np.ndarray, hot: np.ndarray, hot_tokens: np.ndarray, hot_kept: np.ndarray) -> DataFrame:
    """A row for each bucket and block: `doc`, the block's documents with a bigram here, and their sums of base, known and score;
    `late_doc`, `late_hot` and `late_times`, how often a spread context backs off in a document.  And a row without a block for each
    bucket: of each spread context, `hot`, the unigram probability of the words seen after it here."""

    def run(rows: pa.Table, counted: pa.Table) -> pa.Table:
        parts: list[dict] = []

        if rows.num_rows:
            found = Bucket(rows)
            at = found.hot_places(hot)
            counts = np.zeros(len(found.words), "i8")
            counts[np.searchsorted(found.words, counted.column("key").to_numpy().view("u8"))] = counted.column("n").to_numpy()
            alone = unigrams.probabilities(counts)
            seen = found.counts > 0
            held = discounted(found.counts, ratios)
            tokens, kept = found.by_context(found.counts), found.by_context(held)
            seen_alone = found.by_context(np.where(seen, alone[found.two], 0.0))
            spread = at >= 0
            tokens[spread], kept[spread] = hot_tokens[at[spread]], hot_kept[at[spread]]
            mass = np.maximum(tokens, kept + LEAST_LEFT)
            backoff = np.where(tokens > 0, np.log10(1 - kept / mass) - np.where(spread, 0.0, np.log10(1 - np.where(spread, 0.0, seen_alone))), 0.0)
            here = found.context
            score = np.where(seen, np.log10(np.where(seen, held, 1.0) / mass[here]), backoff[here] + np.log10(alone[found.two]))
            base, is_known = np.log10(counts[found.two] + 1.0), counts[found.two] > 0
            late = np.where(seen, -1, at[here])
            parts.append({"hot": at[spread], "seen": seen_alone[spread]})
            low = 0
            for block, in_docs, doc, times, n_docs in found.blocks:
                pair = np.repeat(found.inverse[low : low + len(in_docs)], in_docs)
                low += len(in_docs)
                times = times.astype("i8")
                some = np.flatnonzero(np.bincount(doc, minlength=n_docs))
                sums = [np.bincount(doc, times * v[pair], n_docs)[some] for v in (base, is_known, score)]
                waits = late[pair] >= 0
                both, where = np.unique(doc[waits].astype("i8") * max(len(hot), 1) + late[pair][waits], return_inverse=True)
                late_doc, late_hot = np.divmod(both, max(len(hot), 1))
                late_times = np.bincount(where, times[waits], len(both))
                parts.append({"block": block, "doc": some, "base": sums[0], "known": sums[1], "score": sums[2], "late_doc": late_doc, "late_hot": late_hot, "late_times": late_times})
        columns = [pa.array([p.get("block") for p in parts], pa.int64())]
        columns += [pa.array([None if n not in p else p[n].astype(k.to_pandas_dtype()) for p in parts], pa.list_(k)) for n, k in PART_ARRAYS.items()]
        return pa.Table.from_arrays(columns, names=["block", *PART_ARRAYS])

    shape = "block long, " + ", ".join(f"{n} array<{ {'int32': 'int', 'int64': 'long', 'double': 'double'}[str(k)]}>" for n, k in PART_ARRAYS.items())
    grouped = packed.where("bucket >= 0").groupBy("bucket").cogroup(known.groupBy("bucket"))
    return grouped.applyInArrow(run, shape)


def _added_up(rows: DataFrame, log_left: np.ndarray) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base, score) of the documents of each block."""

    def run(block: pa.Table) -> pa.Table:
        columns = {name: block.column(name) for name in block.column_names}
        own = next(i for i in range(block.num_rows) if columns["ids"][i].is_valid)
        ids, held, tokens = (columns[c][own].values for c in ("ids", "held", "tokens"))
        sums = np.zeros((3, len(ids)))
        for i in range(block.num_rows):
            if i != own:
                doc, base, known, score, late_doc, late_hot, late_times = (columns[c][i].values.to_numpy() for c in list(PART_ARRAYS)[:7])
                sums[:, doc] += (base, known, score)
                np.subtract.at(sums[2], late_doc, late_times * log_left[late_hot])
        arrays = [ids, held, tokens, pa.array(np.rint(sums[1]).astype("i8")), pa.array(sums[0]), pa.array(sums[2])]
        return pa.Table.from_arrays(arrays, names=["doc_id", "held_out", "n_tokens", "n_known", "base", "score"])

    return rows.groupBy("block").applyInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double")


def katz_scores(rows: DataFrame, hot_share: int = HOT_SHARE, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """Scores of `rows` (doc_id, text, held_out), which has no nulls in held_out: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score."""
    spark = rows.sparkSession
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "held_out")
    words = stored(word_counts(rows))
    word_keys, keyed = Keys.apart(words)
    keyed = keyed.where("n > 0")
    few = [F.count_if(F.col("n") == r) for r in range(1, KATZ + 2)]
    n_tokens, n_types, ends, *counts = keyed.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("word") == "", F.col("n"))), F.lit(0)), *few).first()
    unigrams = Unigrams.of(n_tokens, n_types, counts)

    # Contexts with a share of 1 / hot_share of all tokens: at most hot_share.  The start of a text is always one.
    often = keyed.where((F.col("n") * hot_share >= n_tokens) & (F.col("word") != "")).select("key").collect()
    hot = np.unique(np.concatenate([word_keys.of([START]), np.array([r["key"] for r in often], "i8").view("u8")]))
    buckets = max(spark.sparkContext.defaultParallelism, -(-n_tokens // bucket_tokens))
    packed = packed_bigrams(rows, word_keys, hot.view("i8").tolist(), buckets)

    merged = stored(bucket_counts(packed, hot))
    ratios = discounts(list(merged.agg(*(F.coalesce(F.sum(F.get("counts", F.lit(r))), F.lit(0)) for r in range(KATZ + 1))).first()))
    spread = merged.select(F.posexplode("hot").alias("i", "at"), "hot_tokens", "hot_few")
    spread = spread.groupBy("at").agg(F.sum(F.get("hot_tokens", F.col("i"))), *(F.sum(F.get("hot_few", F.col("i") * KATZ + r)) for r in range(KATZ))).collect()
    hot_tokens, hot_kept = np.zeros(len(hot), "i8"), np.zeros(len(hot))
    for at, tokens, *types in spread:
        hot_tokens[at] = tokens
        hot_kept[at] = tokens - sum(n * r * (1 - ratios[r]) for r, n in enumerate(types, 1))

    asked = merged.select("bucket", F.explode("words").alias("key"))
    known = asked.join(keyed.select("key", "n"), "key").select("bucket", "key", "n")
    parts = stored(bucket_scores(packed, known, unigrams, ratios, hot, hot_tokens, hot_kept))

    # At most hot_share + 1 rows: what the words seen after a spread context leave of the unigrams.
    seen = parts.where("block is null").select(F.explode(F.arrays_zip("hot", "seen")).alias("h")).groupBy("h.hot").agg(F.sum("h.seen").alias("seen")).collect()
    log_left = np.zeros(len(hot))
    for r in seen:
        log_left[r["hot"]] = np.log10(1 - r["seen"])
    rows_in = packed.where("bucket < 0").select("block", "ids", "held", "tokens").unionByName(parts.where("block is not null").drop("hot", "seen"), allowMissingColumns=True)
    found = _added_up(rows_in, log_left)
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(float(np.log10(n_tokens + n_types + 1)))).alias("base_score"),
        "score",
    )


def held_out_by_id(docs: DataFrame, parts: int = 7, out: int = 2) -> DataFrame:
    """`docs` as rows for `katz_scores`: those whose id has the remainder `out` are held out."""
    ids = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    return docs.select("doc_id", "text", (F.crc32(ids) % parts == out).alias("held_out"))


def score_digest(docs: DataFrame) -> DataFrame:
    return katz_scores(held_out_by_id(docs))
