"""The registered corpus queries against their SQL twins or, where SQL cannot express them, against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
import xxhash
from compare import TABLES, connect, differences
from corpus_fixtures import docs, items, nothing, ordered, rows  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from trilayer.llm import quality, simhash, suffix_dedup
from trilayer.llm.common import documents, plain_words
from trilayer.llm.components import connected_components
from trilayer.llm.decontaminate import clean_documents, find_contamination
from trilayer.llm.edit_counts import PRE_TOKEN, CountTree, Edit, added_tokens, edited_token_counts, edited_trees, planned_edits, pre_token_counts
from trilayer.llm.licenses import BASE, Notice, license_scan, scan
from trilayer.llm.line_dedup import LineRuns, dedup_lines, line_digest
from trilayer.llm.oracles import ORACLES
from trilayer.llm.packing import Packs, pack_documents, packing_digest, sequences
from trilayer.llm.pii import find_personal_data, personal_data_digest
from trilayer.llm.queries import QUERIES, TOKENIZERS
from trilayer.llm.sharding import MULTIPLIER, shard_digest, shard_documents
from trilayer.llm.simhash import near_duplicate_digest, one_of_each
from trilayer.llm.suffix_dedup import without_repeats
from trilayer.llm.tokens import CachedTokenizer

SF_DIR, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
WORD_FILE, BYTE_FILE = f"{TOKENIZERS}/word_bpe_49k.json", f"{TOKENIZERS}/byte_bpe_50k.json"
SPACE = " \t\n\x0b\x0c\r"


def by_text(rows, compute):
    """(doc_id, *compute(text)) of every row, as `ordered` gives them."""
    return sorted(((i, *compute(t or "")) for i, t, *_ in rows), key=str)


@pytest.fixture(scope="module")
def con():
    connection = connect(SF_DIR)
    for name in {"documents", "benchmark"} - set(TABLES):
        connection.execute(f"create view {name} as select * from read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_twin(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


# 1 quality


def brute_quality(text):
    words = regex.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed


def test_quality_counts(docs, rows, ordered):
    found = quality.quality_digest(docs, quality.UNTRAINED)
    assert ordered(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == by_text(rows, brute_quality)
    assert all(not r["kept"] for r in found.collect() if r["base_failed"])
    kept = quality.good_documents(docs, quality.UNTRAINED)
    assert kept.columns == docs.columns and kept.count() == found.where("kept").count()


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(1)
    for n in range(1, 9):
        field = quality.LineField(rng.normal(size=len(quality.FEATURES)), rng.normal(size=(2, 2)))
        x = rng.normal(size=(n, len(quality.FEATURES)))

        def score(path):
            return sum(x[i] @ field.state * s for i, s in enumerate(path)) + sum(field.step[a, b] for a, b in zip(path, path[1:]))

        best = max((tuple(int(k) >> i & 1 for i in range(n)) for k in range(1 << n)), key=score)
        assert tuple(quality.viterbi(x, field).astype(int)) == best


def test_sums_over_paths_match_enumeration():
    rng = np.random.default_rng(2)
    sizes, longest = [1, 3, 5, 6], 6
    field = quality.LineField(rng.normal(size=len(quality.FEATURES)), rng.normal(size=(2, 2)))
    x, there = np.zeros((4, longest, len(quality.FEATURES))), np.zeros((4, longest), dtype=bool)
    for i, size in enumerate(sizes):
        x[i, :size], there[i, :size] = rng.normal(size=(size, len(quality.FEATURES))), True
    whole, likely, steps = quality.expected(x, there, field)
    wanted_steps = np.zeros((2, 2))
    for i, size in enumerate(sizes):
        paths = list(itertools.product((0, 1), repeat=size))
        weight = np.array([np.exp(sum(x[i, t] @ field.state * s for t, s in enumerate(p)) + sum(field.step[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        assert np.isclose(whole[i], np.log(weight.sum()))
        share = weight / weight.sum()
        assert np.allclose(likely[i, :size], share @ np.array(paths)) and not likely[i, size:].any()
        for p, w in zip(paths, share):
            for a, b in zip(p, p[1:]):
                wanted_steps[a, b] += w
    assert np.allclose(steps, wanted_steps)


def test_composed_sequences_hold_every_line_once():
    rng = np.random.default_rng(3)
    lines = [rng.normal(size=(size, 2)) for size in (1, 300, 7, 20, 0, 4)]
    bad = [1, 0, 0, 1, 1, 0]
    sequences = quality.composed(lines, bad)
    found = sorted((int(s), *row) for rows, states in sequences for row, s in zip(rows, states))
    assert found == sorted((b, *row) for rows, b in zip(lines, bad) for row in rows)
    assert all(quality.SEQUENCE <= len(states) < quality.SEQUENCE + quality.STRETCH for _, states in sequences[:-1])
    again = quality.composed(lines, bad)
    assert all(np.array_equal(a, c) and np.array_equal(b, d) for (a, b), (c, d) in zip(sequences, again))


@pytest.fixture(scope="module")
def halves(spark):
    """A field fitted on documents of even id, and lines of the others, by rating."""
    docs, labels = documents(spark, "/root/testdata/sf0.1"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    field = quality.fit_on_labels(docs, labels.where("doc_id % 2 = 0"))
    held_out = docs.join(labels.where("doc_id % 2 = 1 and quality in (0, 1)"), "doc_id").where("text is not null")
    lines = ([], [])
    for row in held_out.select("doc_id", "quality", "text").orderBy("doc_id").collect():
        lines[row["quality"]].append([line for line in row["text"].split("\n") if line.strip(SPACE)])
    return field, lines


@pytest.mark.parametrize("size", [3, 5, 8])
def test_field_switches_inside_a_text(halves, size):
    """Texts of good and bad stretches in turn: nine lines in ten get their own state, and both states occur."""
    field, lines = halves
    rng, right, total, mixed = np.random.default_rng(size), 0, 0, 0
    pools = [[text for text in lines[rating] if len(text) >= size] for rating in (1, 0)]
    for _ in range(200):
        text, wanted = [], []
        for turn in range(6):
            pool = pools[turn % 2]
            whole = pool[rng.integers(len(pool))]
            at = rng.integers(len(whole) - size + 1)
            text += whole[at : at + size]
            wanted += [turn % 2 == 1] * size
        states = quality.viterbi(quality.line_features("\n".join(text))[0], field)
        right, total, mixed = right + (states == np.array(wanted)).sum(), total + len(wanted), mixed + (0 < states.sum() < len(states))
    assert right >= 0.9 * total and mixed >= 195


def test_content_share_decides(halves):
    """A good text with a bad stretch of under half its words stays, one with over half goes."""
    field, lines = halves
    good = [text for text in lines[1] if len(text) >= 6][:40]
    bad = [text for text in lines[0] if len(text) >= 6][:40]
    shares = [[quality.judge("\n".join(g[:n] + b[: 6 - n]), field).content_share for g, b in zip(good, bad)] for n in (6, 4, 2, 0)]
    means = [np.mean(s) for s in shares]
    assert means == sorted(means, reverse=True) and means[0] > 0.95 and means[3] < 0.1
    assert sum(0 < s < 1 for s in shares[1] + shares[2]) >= 60


def test_field_tells_good_from_bad(spark):
    docs, labels = documents(spark, "/root/testdata/sf0.1"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held_out = labels.where("doc_id % 2 = 1").join(documents(spark, "/root/testdata/sf0.1"), "doc_id")
    field = quality.fit_on_labels(docs, labels.where("doc_id % 2 = 0"), sample=300)
    judged = quality.quality_digest(held_out, field).join(labels, "doc_id").where("not base_failed")
    counts = {(r["quality"], r["kept"]): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) <= 0.01 * counts[1, True]
    assert counts.get((0, True), 0) <= 0.05 * counts[0, False]


def test_field_without_labels_of_both_kinds(spark, docs):
    for labels in ([], [(5, 1), (6, 1)], [(5, None), (None, 0)]):
        assert quality.fit_on_labels(docs, spark.createDataFrame(labels, "doc_id long, quality int")) is quality.UNTRAINED


def test_field_is_fitted_on_a_row_for_each_id(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(quality, "fit", lambda lines, ratings: fitted.append((len(lines), sorted(ratings))))
    docs = spark.createDataFrame([(i if i < 6 else 1, f"some words and the number {i}\nanother line") for i in range(200)], "doc_id long, text string").repartition(4)
    quality.fit_on_labels(docs, spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int"))
    assert fitted == [(6, [0, 0, 0, 1, 1, 1])]


# 2 shards


def published_jump(key, n):
    key, b, j = key % (1 << 64), -1, 0
    while j < n:
        b = j
        key = (key * MULTIPLIER + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shards_follow_the_published_hash(spark, docs, rows):
    ids = [0, 1, -1, 7, 2**63 - 1, -(2**63), 123456789012345, None] + list(range(2, 300))
    found = shard_documents(spark.createDataFrame([(i, "é") for i in ids], "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["shard"], r["grown_shard"]) for r in found} == {(i, published_jump(i or 0, 24), published_jump(i or 0, 25)) for i in ids}
    assert {r["size"] for r in found} == {10}
    for result in (found, shard_documents(docs).collect()):
        slots = Counter((r["shard"], r["slot"]) for r in result)
        assert max(slots.values()) == 1
        assert all(slots[shard, i] for shard in {s for s, _ in slots} for i in range(sum(s == shard for s, _ in slots)))
    assert sorted((r["doc_id"], r["text_crc32"]) for r in result if r["doc_id"] is not None) == sorted((i, zlib.crc32((t or "").encode())) for i, t, *_ in rows if i is not None)


def test_shards_hold_the_documents(docs, rows):
    found = shard_documents(docs)
    assert Counter(tuple(r["document"]) for r in found.select("document").collect()) == Counter(rows)
    assert Counter(map(tuple, shard_digest(docs).collect())) == Counter(tuple(r)[:-1] for r in found.collect())


# 3 packing


def test_pieces_and_packs(docs, rows):
    tokenizer = Tokenizer.from_file(WORD_FILE)
    found = [r.asDict() for r in pack_documents(docs, WORD_FILE, length=64).collect()]
    sequences: dict = {}
    pieces = Counter()
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces[r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]] += 1
    for parts in sequences.values():
        assert sum(n for _, n in parts) <= 64
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
    wanted = Counter()
    for i, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for at in range(0, len(ids), 64):
            part = ids[at : at + 64]
            wanted[i, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert pieces == wanted


def test_sequences_hold_the_ids(docs, rows):
    tokenizer = Tokenizer.from_file(WORD_FILE)
    packed = pack_documents(docs, WORD_FILE, length=64)
    found = [(np.frombuffer(r["ids"], "<u4").tolist(), r["pieces"]) for r in sequences(packed).collect()]
    assert all(len(ids) == sum(p["length"] for p in pieces) <= 64 for ids, pieces in found)
    got = Counter((p["doc_id"], p["start"], tuple(ids[p["offset"] : p["offset"] + p["length"]])) for ids, pieces in found for p in pieces)
    wanted = Counter()
    for i, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        wanted.update((i, at, tuple(ids[at : at + 64])) for at in range(0, len(ids), 64))
    assert got == wanted
    assert Counter(map(tuple, packing_digest(docs, WORD_FILE, length=64).collect())) == Counter(tuple(r)[:-1] for r in packed.collect())


def test_packs_are_full():
    rng = random.Random(3)
    lengths = Counter(min(2048, max(1, int(rng.lognormvariate(5.5, 1.3)))) for _ in range(50_000))
    for histogram in (lengths, lengths | Counter({1: 60_000}), Counter({1: 5000}), Counter({600: 10}), Counter({2048: 3})):
        packs = Packs(histogram, 2048)
        n = sum(count for segments in packs.open.values() for count, _ in segments)
        tokens = sum(size * count for size, count in histogram.items())
        assert n <= max(tokens / 2048 / 0.97, -(-sum(histogram.values()) // (2048 // max(histogram))) if len(histogram) == 1 else 0) + 1
        assert {size: int(sum(np.diff([*runs["rank"], histogram[size]]))) for size, runs in packs.runs().items()} == dict(histogram)


def test_cached_ids_are_the_tokenizer_s(rows):
    cached, plain = CachedTokenizer(WORD_FILE), Tokenizer.from_file(WORD_FILE)
    texts = [t or "" for _, t, *_ in rows] + ["<|endoftext|> x", "İ ǅ ﬁ “don't” I'LL", "a\x1cb\x85c d　e", "!'s ''ll 12,5 é̈", "中文 テスト x"]
    for text in texts:
        assert cached.of_text(text).tolist() == plain.encode(text, add_special_tokens=False).ids


# 4 lines


def brute_lines(rows):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))

    holders: dict = {}
    for n, (i, text, *_) in enumerate(rows):
        for k in {key(line) for line in (text or "").split("\n")}:
            holders.setdefault(k, []).append(-1 if i is None else i)
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if len(key(line)) < 20 or len(holders[key(line)]) < 3 or (-1 if i is None else i) == max(holders[key(line)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("batches, fan_out", [(1, 4), (4, 4), (5, 2)])
def test_lines(docs, rows, ordered, batches, fan_out):
    wanted = brute_lines(rows)
    assert sum(n for _, _, n, _ in wanted) > 4
    found = line_digest(docs, batches=batches, fan_out=fan_out)
    assert ordered(found, "doc_id", "n_lines", "n_dropped", "kept_sha256") == sorted(((i, a, b, hashlib.sha256(t.encode()).hexdigest()) for i, a, b, t in wanted), key=str)


def test_runs_are_reopened_for_a_later_batch(spark, tmp_path):
    """Smaller and larger ids in any order of batches, each by runs that were opened anew, as one call over all."""
    docs = documents(spark, SF_DIR)
    wanted = sorted(map(tuple, line_digest(docs).collect()))
    assert sum(row[2] for row in wanted) > 100
    middle = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    batches = [docs.where(F.col("doc_id") <= middle), docs.where((F.col("doc_id") > middle) & (F.col("doc_id") % 2 == 0)), docs.where((F.col("doc_id") > middle) & (F.col("doc_id") % 2 == 1))]
    folder = str(tmp_path / "runs")
    runs = LineRuns(spark, fan_out=2, folder=folder)
    for batch in batches:
        line_digest(batch, batches=2, runs=runs)
        runs = LineRuns.load(spark, folder, fan_out=2)
    # Six batches, two to a compaction: one run of four batches, one of two.
    assert [len(level) for level in runs.levels] == [0, 1, 1]
    again = [line_digest(batch, runs=LineRuns.load(spark, folder), added=True) for batch in batches]
    assert sorted(tuple(row) for found in again for row in found.collect()) == wanted
    # A run that no list names does not count.
    spark.range(3).write.parquet(f"{folder}/line_run_cut_off")
    assert LineRuns.load(spark, folder).totals().count() == runs.totals().count()
    assert all("Exchange" not in run.groupBy("high").count()._jdf.queryExecution().toString() for run in runs.all())


def test_lines_leave_the_other_columns(docs, rows):
    kept = dedup_lines(docs)
    assert kept.schema == docs.schema
    assert Counter((r["doc_id"], r["text"] or "") for r in kept.collect()) == Counter((i, t) for i, _, _, t in brute_lines(rows))


# 5 near-duplicates


def brute_print(text):
    words = regex.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def simhash_roots(prints):
    """(doc_id, print) to the number of a component, for each row."""
    root: dict = {}
    for i, (_, a) in enumerate(prints):
        near = {root[j] for j in range(i) if (a ^ prints[j][1]).bit_count() <= 3}
        root |= {j: i for j, r in root.items() if r in near} | {i: i}
    return [root[i] for i in range(len(prints))]


def brute_components(prints):
    """(doc_id, print) to the smallest doc_id reachable."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
                root[find(i)] = find(j)
    least: dict = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [least.get(find(i)) for i in range(len(prints))]


@pytest.mark.parametrize("block", [1024, 2])
def test_near_duplicates(docs, rows, ordered, block):
    prints = [(i, brute_print(t or "")) for i, t, *_ in rows]
    wanted = [(i, f"{p:016x}", c) for (i, p), c in zip(prints, brute_components(prints))]
    assert len({c for *_, c in wanted}) < len({p for _, p, _ in wanted})
    assert ordered(near_duplicate_digest(docs, block=block), "doc_id", "fingerprint", "component_id") == sorted(wanted, key=str)


def test_links_of_dense_prints(spark):
    rng = random.Random(4)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(40):
            prints.add(at)
            for _ in range(rng.randint(1, 5)):
                at ^= 1 << rng.randrange(64)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "print long")
    wanted = brute_components([(i, p) for i, p in enumerate(prints)])
    for block in (1024, 7):
        links = simhash.linked_prints(table, block=block)
        assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in links.collect())
        roots = {r["node"]: r["root"] for r in connected_components(links).collect()}
        groups: dict = {}
        for p, w in zip(signed, wanted):
            groups.setdefault(roots.get(p, p), set()).add(w)
        assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(wanted))


def test_one_of_each(docs, rows):
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    components = brute_components([(i, brute_print(t or "")) for i, t, *_ in rows])
    assert {r["doc_id"] for r in kept.collect()} == set(components)


def test_one_row_of_each(spark, docs, rows):
    """Copies with null ids, near copies with null ids, repeated rows, an id that is the smallest of two components."""
    base, other = rows[5][1], "quite another text of a few words"
    rng = random.Random(12)
    words = [f"w{rng.randrange(300)}" for _ in range(400)]
    prints = {}
    for i in range(400):
        text = " ".join([*words[:i], "changed", *words[i + 1 :]])
        prints.setdefault((brute_print(text) ^ brute_print(" ".join(words))).bit_count(), text)
    near = [" ".join(words), *(prints[n] for n in (1, 2, 3) if n in prints)]
    assert len(near) > 1
    more = [*[(None, t) for t in near * 3], *[(7, other)] * 4, *[(9000, base)] * 3, *[(None, "null ids only")] * 5, *[(None, None)] * 2]
    small = [(i, t) for i, t, *_ in rows] + more
    table = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(small)], "doc_id long, text string, kept_id int").repartition(5)
    prints = [(i, brute_print(t or "")) for i, t in small]
    roots = simhash_roots(prints)
    wanted = Counter()
    for root in set(roots):
        ids = [i for (i, _), r in zip(prints, roots) if r == root and i is not None]
        wanted[min(ids, default=None)] += 1
    found = one_of_each(table)
    assert found.columns == table.columns
    found = found.collect()
    assert Counter(r["doc_id"] for r in found) == wanted and wanted[7] > 1 and wanted[None] > 1
    place = {n: root for n, root in enumerate(roots)}
    assert len({place[r["kept_id"]] for r in found}) == len(found)
    assert all((r["doc_id"], r["text"]) == small[r["kept_id"]] for r in found)


# 6 licenses


def brute_base(text):
    words = plain_words(text)
    places = [(i, label) for phrase, label in BASE for i in range(len(words)) if b" ".join(words[i : i + len(phrase.split())]) == phrase.encode()]
    return len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places}))


def test_license_base(docs, rows, ordered):
    found = license_scan(docs)
    assert ordered(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == by_text(rows, brute_base)
    for r in found.collect():
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert r["score"] == 1 or not r["n_base"]


def test_seeds_miss_no_edited_notice():
    rng = random.Random(6)
    notice = Notice("licensed under the apache license version 2 0", "apache", 4)
    for _ in range(200):
        chars = list(notice.words)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(1, len(chars) - 1)
            chars[at : at + rng.randint(0, 1)] = rng.choice(["", "q"])
        line = f" some text before {''.join(chars)} and behind "
        whole = notice.pattern.search(line)
        assert (whole is not None) == bool(notice.find(line))
    _, _, fuzzy = scan("Héllo!  Distributed under the GNU Genral Public\nLicence; see below")
    assert [(s.label, s.edits) for s in fuzzy] == [("gpl", 2)]
    assert "Héllo!  Distributed under the GNU Genral Public\nLicence; see below"[fuzzy[0].start : fuzzy[0].end] == "GNU Genral Public\nLicence"


def test_dense_notices_are_all_found():
    """Edited notices next to exact ones, some thousand in one text."""
    notice = Notice("gnu general public license", "gpl", 2)
    texts = ["gnu genral public license", notice.words, "gnu general publik license", "gnu generall public licence"]
    line = f" {' '.join(texts * 1000)} "
    found = notice.find(line)
    assert [line[a:b] for a, b, _ in found] == texts * 1000
    assert [edits for *_, edits in found] == [1, 0, 1, 2] * 1000


# 7 decontamination


@pytest.mark.parametrize("most", [1 << 20, 10])
def test_contamination(spark, items, most):
    text = "x Alpha, BETA gamma delta epsilon zeta eta theta iota kappa lambda y. Short\n\none né ka short"
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "short on e"), (None, "short one"), (4, "alpha beta gamma delta epsilon zeta eta theta iota")], "doc_id long, text string")
    found = {(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in find_contamination(docs, items, most=most).drop("spans").collect()}
    sha = {ids: hashlib.sha256(ids.encode()).hexdigest() for ids in ("", "2", "1,10,2")}
    assert found == {(1, 18, 15, 3, sha["1,10,2"], True), (2, 0, 0, 0, sha[""], False), (3, 0, 0, 0, sha[""], False), (4, 3, 0, 0, sha[""], False), (None, 2, 2, 1, sha["2"], True), (4, 9, 0, 0, sha[""], False)}
    spans = [text[s["start"] : s["end"]] for s in find_contamination(docs, items, most=most).where("doc_id = 1").first()["spans"]]
    assert spans == ["Alpha, BETA gamma delta epsilon zeta eta theta iota kappa lambda", "Short\n\none né ka"]
    assert {r["doc_id"] for r in clean_documents(docs, items, most=most).collect()} == {2, 3, 4}


def test_no_items(spark, docs):
    assert clean_documents(docs, spark.createDataFrame([], "item_id long, text string")).count() == docs.count()


# 8 personal data


def brute_private(text):
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := [int(c) for c in m if c in "0123456789"]) <= 19 and sum(sum(divmod(x * (1 + i % 2), 10)) for i, x in enumerate(d[::-1])) % 10 == 0),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= sum(c in "0123456789" for c in m) <= 15),
    }
    spans = {kind: [f"{kind}:{m.start()}:{m.end()}" for m in regex.finditer(p, text) if good(m.group())] for kind, (p, good) in kinds.items()}
    return *map(len, spans.values()), hashlib.sha256(",".join(sum(spans.values(), [])).encode()).hexdigest()


def test_private_base(spark, docs, rows, ordered):
    odd = [(100, "a@b.c_d@e.f foo@bar@baz.com 1.2.3.4.5.6.7.8 +1 2 3 4 5 6 7 8 9+1-234-567-89 "), (101, "4" * 40), (102, "4111111111111111 " * 700), (103, "\U0001f600 é x@y.zz"), (104, "5 5-5 5")]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    assert ordered(personal_data_digest(more), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == by_text([*rows, *odd], brute_private)


def test_private_added_kinds(docs, rows):
    found = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] in ("iban", "identity")] for r in find_personal_data(docs).collect()}
    texts = {i: t for i, t, *_ in rows}
    got = sorted((kind, texts[i][a:b]) for i, spans in found.items() for kind, a, b in spans)
    assert got == [("iban", "DE89370400440532013000"), ("iban", "GB82 WEST 1234 5698 7654 32"), ("identity", "123-45-6789"), ("identity", "123-45-6789")]


def test_account_numbers_before_any_text(spark):
    """Numbers made here, put before and behind texts; where they stand is known."""
    rng = random.Random(9)
    texts, wanted = [], {}
    lengths = {"NO": 15, "BE": 16, "AT": 20, "DE": 22, "ES": 24, "SE": 24, "CZ": 24, "FR": 27, "PL": 28, "HU": 28, "CY": 28, "MT": 31}
    behind = ["", " A", " Amount", " EUR", " AMOUNT DUE 12", " A1", " eur", ", B", ".", "\nABCD 1234", " BE"]
    for country, size in lengths.items():
        for end in behind:
            body = "".join(rng.choice("0123456789") for _ in range(size - 4))
            check = 98 - int("".join(str(int(c, 36)) for c in f"{body}{country}00")) % 97
            number = f"{country}{check:02}{body}"
            for written in (number, " ".join(number[i : i + 4] for i in range(0, size, 4))):
                if not (size % 4 and written != number and end == " A1"):
                    text = f"é Pay {written}{end}"
                    wanted[len(texts)] = [(6, 6 + len(written))]
                    texts.append(text)
    pair = "BE68539007547034"
    wanted[len(texts)] = [(0, 16), (17, 33)]
    texts.append(f"{pair} {pair}")
    wanted |= {len(texts): [], len(texts) + 1: []}
    texts += [f"X{pair} {pair}a", "BE68539007547035 A"]
    found = find_personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "iban"] for r in found}
    assert {texts[i]: got[i] for i in got if got[i] != wanted[i]} == {}


def test_context_on_both_sides(spark):
    texts = ["123-45-6789 is the SSN", "SSN: 123-45-6789", "123-45-6789, social security", "classname 123-45-6789", "123-45-6789" + " x" * 30 + " ssn"]
    found = find_personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: len(r["spans"]) for r in found} == {0: 1, 1: 1, 2: 1, 3: 0, 4: 0}


# 9 repeated passages


def brute_repeats(rows):
    texts = [(t or "").encode() for _, t, *_ in rows]
    windows = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for (i, *_), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, dtype=bool)
        for at in range(len(t) - 199):
            if windows[t[at : at + 200]] > 1:
                gone[at : at + 200] = True
        spans = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(t) else 0
        kept = bytes(np.frombuffer(t, dtype="u1")[~gone[:-1]]) if t else b""
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("group, chunk", [(4000, 1 << 20), (1, 1000)])
def test_repeated_passages(docs, rows, ordered, monkeypatch, group, chunk):
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    assert ordered(without_repeats(docs, group), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_repeats(rows)


def test_repeated_passages_of_the_table(spark, ordered):
    docs = documents(spark, SMALL)
    wanted = brute_repeats([(r["doc_id"], r["text"]) for r in docs.collect()])
    for group in (4000, 1):
        assert ordered(without_repeats(docs, group), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == wanted


@pytest.mark.parametrize("letters", [1, 2, 250])
def test_radix_passes_compare_all_bytes(letters):
    rng = np.random.default_rng(letters)
    text = rng.integers(0, letters, 3000, dtype="u1")
    text[1000:1400] = text[200:600]
    text[2000:2199] = text[300:499]  # one byte short of a window
    text[2199] = text[499] + 1
    start = np.arange(len(text) - suffix_dedup.WINDOW + 1)
    group = start % 2
    seen = Counter((g, text[i : i + suffix_dedup.WINDOW].tobytes()) for i, g in zip(start.tolist(), group.tolist()))
    wanted = [i for i, g in zip(start.tolist(), group.tolist()) if seen[g, text[i : i + suffix_dedup.WINDOW].tobytes()] > 1]
    found = suffix_dedup._radix_passes(text, start, group)
    assert sorted(found.tolist()) == wanted
    in_order = [(i % 2, text[i : i + suffix_dedup.WINDOW].tobytes()) for i in found.tolist()]
    assert in_order == sorted(in_order)
    assert suffix_dedup._radix_passes(text[:0], start[:0], group[:0]).size == 0


def test_anchors_across_chunks(monkeypatch):
    rng = np.random.default_rng(2)
    text = rng.integers(97, 100, 30_000, dtype="u1")
    ends = np.array([100, 100, 12_345, 30_000])
    whole = suffix_dedup._anchors(text, ends)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 777)
    assert all((a == b).all() for a, b in zip(whole, suffix_dedup._anchors(text, ends)))
    assert whole[1].sum() == 12_245 - 199 + 17_655 - 199


# 10 counts


def test_edited_counts(docs, rows, ordered):
    tokenizer = Tokenizer.from_file(BYTE_FILE)

    def compute(text):
        n = len(text)
        edited = "Reviewed. " + text
        third = n // 3
        edited = edited[:third] + " [removed] " + edited[third + min(third, 40) :]
        start = min(max(n - 100, 0), len(edited))
        edited = edited[:start] + edited[min(max(n + 100, start), len(edited)) :]
        return len(tokenizer.encode(text, add_special_tokens=False).ids), len(tokenizer.encode(edited, add_special_tokens=False).ids), len(edited)

    found = edited_token_counts(planned_edits(docs), BYTE_FILE)
    assert ordered(found, "doc_id", "n_tokens", "n_tokens_edited", "n_chars_edited") == by_text(rows, compute)


def test_tree_follows_any_edits():
    rng = random.Random(8)
    alphabet = "ab  \n\t.!'sé1"

    def some(n):
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, n)))

    for _ in range(300):
        tree = CountTree(some(600), len)
        for _ in range(6):
            text, start = tree.text, rng.randint(0, len(tree.text))
            end, new = rng.randint(start, min(len(text), start + 30)), some(12)
            tree.apply(Edit(start, end, new))
            assert tree.text == text[:start] + new + text[end:]
            assert [n for leaf in tree.leaves for n in leaf] == [len(t) for t in PRE_TOKEN.findall(tree.text)]
            assert tree.n_tokens == len(tree.text) and tree.chars[1] == len(tree.text)
            assert (tree.chars[1 : tree.width] == tree.chars[2::2] + tree.chars[3::2]).all()


def test_added_tokens_are_one_token(spark):
    tokenizer = Tokenizer.from_file(BYTE_FILE)
    rng = random.Random(10)
    count, added = pre_token_counts(BYTE_FILE), added_tokens(BYTE_FILE)
    mark = "<|endoftext|>"

    def n_tokens(text):
        return len(tokenizer.encode(text, add_special_tokens=False).ids)

    def some(n):
        return "".join(rng.choice(["ab", " ", "  ", "\n", "é", "1", "'s", mark, mark, mark[:5], mark[5:], mark[1:], "<", "|>"]) for _ in range(rng.randint(0, n)))

    for _ in range(300):
        tree = CountTree(some(150), count.__getitem__, added)
        assert tree.n_tokens == n_tokens(tree.text)
        for n in range(8):
            start = rng.randint(0, len(tree.text))
            tree.apply(Edit(start, start + rng.randint(0, 15), some(2)))
            assert tree.n_tokens == n_tokens(tree.text)
            if n == 4:
                tree = CountTree(tree.text, count.__getitem__, added, tuple(x.tolist() for x in tree.stored_leaves()))
                assert tree.encoded == 0 and tree.n_tokens == n_tokens(tree.text)
    texts = [f"end of text {mark} next", f"a  {mark}{mark} b" * 50, None, "plain " * 100]
    docs = planned_edits(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r["doc_id"]: r["n_tokens"] for r in edited_token_counts(docs, BYTE_FILE).collect()} == {i: n_tokens(t or "") for i, t in enumerate(texts)}


def test_a_later_batch_loads_the_trees(spark, docs):
    tokenizer = Tokenizer.from_file(BYTE_FILE)
    first = edited_trees(planned_edits(docs), BYTE_FILE).collect()
    again = [(r["doc_id"], r["text"], [(5, 9, "x <|endoftext|> y")], r["lengths"], r["tokens"]) for r in first]
    table = spark.createDataFrame(again, "doc_id long, text string, edits array<struct<start:long,end:long,new:string>>, lengths array<int>, tokens array<int>")
    found = edited_trees(table, BYTE_FILE, loaded=True).collect()
    assert Counter((r["doc_id"], r["n_tokens_edited"], len(r["lengths"])) for r in first) == Counter((r["doc_id"], r["n_tokens"], r["n_pre_tokens"]) for r in found)
    texts = Counter((i, t[:5] + "x <|endoftext|> y" + t[9:]) for i, t, *_ in again)
    assert Counter((r["doc_id"], r["text"]) for r in found) == texts
    assert all(r["n_tokens_edited"] == sum(r["tokens"]) == len(tokenizer.encode(r["text"], add_special_tokens=False).ids) for r in found)
    with pytest.raises(ValueError):
        CountTree("ab", len, None, ([1], [1]))


def test_tree_encodes_little_anew():
    tree = CountTree("some words here and " * 5000, len)
    before = tree.encoded
    tree.apply(Edit(50_000, 50_010, "other"))
    assert tree.encoded - before < 20


# all


def test_empty_tables(nothing, items):
    assert quality.quality_digest(nothing, quality.UNTRAINED).count() == 0
    assert quality.good_documents(nothing, quality.UNTRAINED).count() == 0
    assert shard_documents(nothing).count() == 0
    assert pack_documents(nothing, WORD_FILE).count() == 0
    assert line_digest(nothing).count() == 0
    assert dedup_lines(nothing).count() == 0
    assert near_duplicate_digest(nothing).count() == 0
    assert one_of_each(nothing).count() == 0
    assert license_scan(nothing).count() == 0
    assert find_contamination(nothing, items).count() == 0
    assert personal_data_digest(nothing).count() == 0
    assert without_repeats(nothing).count() == 0
    assert edited_token_counts(planned_edits(nothing), BYTE_FILE).count() == 0


def test_pipeline_stages(spark):
    """Each stage on its own input, by plain Python."""
    docs = documents(spark, SMALL)
    field = quality.fit_on_labels(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rows = [tuple(r) for r in docs.collect()]
    wanted = [r for r in rows if quality.judge(r[1] or "", field).kept]
    assert 0 < len(wanted) < len(rows)
    found = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(docs.collect(), docs.schema) if found else docs
        docs = stage(spark, docs, SMALL)
        found.append(sorted(tuple(r) for r in docs.collect()))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert found[0] == sorted(wanted)
    assert [(r[0], r[1]) for r in found[1]] == sorted((i, t) for i, _, _, t in brute_lines(found[0]))
    prints = [(r[0], brute_print(r[1])) for r in found[1]]
    assert [r[0] for r in found[2]] == sorted(set(brute_components(prints)))
    dirty = {r["doc_id"] for r in find_contamination(spark.createDataFrame(found[2], docs.schema), spark.read.parquet(f"{SMALL}/benchmark.parquet")).where("contaminated").collect()}
    assert [r[0] for r in found[3]] == [r[0] for r in found[2] if r[0] not in dirty]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r[0] for r in found[3]}
    assert corpus_pipeline.run(spark, SMALL).count() == packed.count()
