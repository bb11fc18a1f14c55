"""The prefix trie, whitening and Katz scores against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus_fixtures import docs, nothing, rows  # noqa: F401

from trilayer.llm import katz, prefix_trie, whitening
from trilayer.llm.common import documents
from trilayer.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"

# trie


def brute_trie(turns):
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            pair = (role or "", text or "")
            key = hashlib.sha256(f"{len(pair[0].encode())}:{pair[0]}{pair[1]}".encode()).digest()[:16]
            own[conv].append(((turn is not None, turn or 0), key, pair))
    own = {c: [pair for *_, pair in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    leaves, saved = Counter(), Counter()
    for path, of in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(of) - 1) * len(path[-1][1].encode()) if path else 0
            leaves[path[:d]] += not children[path]
    found = []
    for path, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(built[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        found.append((min(of), len(path), parent, len(of), len(children[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=str)


def trie_of(spark, turns, limit=prefix_trie.BOX):
    df = spark.createDataFrame([(*t, "x", 1) for t in turns], "conv_id long, turn long, role string, text string, window string, depth int").repartition(3)
    return sorted((tuple(r) for r in prefix_trie.conversation_trie(df, limit).collect()), key=str)


def odd_turns():
    rng = random.Random(3)
    turns = []
    for c in range(60):
        shared = c % 3 == 0
        for t in range(rng.randrange(0, 14)):
            turns.append((c, t, "user" if t % 2 else "system", "same é" if shared and t < 11 else f"{rng.randrange(3)}"))
    turns += [(200 + c, t, "user", "copy" + "y" * t) for c in range(40) for t in range(12)]
    turns += [(300, t, None, None) for t in range(150)] + [(305, t, "", "") for t in range(149)] + [(305, 149, "", "end")]
    turns += [(400, None, "user", "no number"), (400, None, "user", "no number"), (400, 0, None, "first"), (400, 0, "a", "tie"), (400, 0, "b", "tie"), (None, 1, "user", "no id")]
    return turns + turns[-9:-6]


@pytest.mark.parametrize("limit", [4096, 2])
def test_trie(spark, limit):
    turns = odd_turns()
    assert trie_of(spark, turns, limit) == brute_trie(turns)


def test_trie_of_next_to_nothing(spark):
    assert trie_of(spark, []) == trie_of(spark, [(None, 1, "user", "text")]) == []
    for turns in ([(7, 0, "user", "a")], [(5, 0, "user", "a"), (6, 0, "user", "a")]):
        assert trie_of(spark, turns) == brute_trie(turns)


def test_query_trie(spark):
    given = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = sorted((tuple(r) for r in QUERIES["op11_prefix_trie"](spark, SMALL).collect()), key=str)
    assert found == brute_trie([tuple(r) for r in given.collect()])


# whitening


def check_whitening(embedded, found, components=4):
    """`found` rows against numpy's own eigenvectors."""
    kept = [(i, [math.floor(256 * c) + 0 for c in v]) for i, v in embedded if v and all(c is not None and math.isfinite(c) for c in v)]
    length = max(Counter(len(v) for _, v in kept).items(), key=lambda x: (x[1], x[0]))[0]
    kept = [(i, v) for i, v in kept if len(v) == length]
    distinct = sorted(set(tuple(v) for _, v in kept))
    x, n = np.array(distinct, dtype="f8"), len(distinct)
    values, vectors = np.linalg.eigh((x - x.mean(axis=0)).T @ (x - x.mean(axis=0)) / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-12 * values.sum()).sum()))
    sums = [sum(v[j] for v in distinct) for j in range(length)]
    assert len(found) == len(kept) * k
    by_row = defaultdict(list)
    for r in found:
        by_row[r["component"]].append(r)
    for j in range(k):
        mine = sorted(by_row[j + 1], key=lambda r: (str(r["vec_id"]), r["deviation"]))
        expected = sorted(((str(i), sum((n * a - s) ** 2 for a, s in zip(v, sums)), float((np.array(v) - x.mean(axis=0)) @ vectors[:, j] / math.sqrt(values[j]))) for i, v in kept))
        assert [(str(r["vec_id"]), r["deviation"]) for r in mine] == [e[:2] for e in expected]
        sign = np.sign(np.dot([r["whitened"] for r in mine], [e[2] for e in expected]))
        assert np.allclose([r["whitened"] * sign for r in mine], [e[2] for e in expected], atol=1e-7)
        assert all(r["n"] == n and r["identity_error"] < 1e-9 and r["explained"] == pytest.approx(values[j] / values.sum(), rel=1e-9) for r in mine)


def embeddings(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, x int, n int").repartition(3)


@pytest.mark.parametrize("d", [1, 3, 50])
def test_whitening(spark, d):
    rng = np.random.default_rng(d)
    rows = [(i, [float(c) for c in np.float32(rng.normal(size=d) * np.arange(d, 0, -1) + 3)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [(None, rows[1][1]), rows[2]]
    rows += [(1, None), (2, []), (3, [None] * d), (4, [math.nan] * d), (5, [math.inf] * d), (6, [1.0] * (d + 1))]
    check_whitening(rows, whitening.whitening_digest(embeddings(spark, rows)).collect())


def test_whitening_without_variance(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whitening_digest(embeddings(spark, rows)).collect() == []
    flat = [(i, [float(i), 2.0 * i, 5.0]) for i in range(20)]
    check_whitening(flat, whitening.whitening_digest(embeddings(spark, flat)).collect())


def test_huge_entries_keep_exact_sums(spark):
    rows = [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 4.0])]
    vectors = whitening.whole_vectors(embeddings(spark, rows))
    n, sums = whitening.exact_sums(vectors)
    assert (n, sums) == (3, [-1, 256 * 7])
    assert {r["deviation"] for r in whitening.whitening_digest(embeddings(spark, rows)).collect()} == {None, 1 + 1280**2}


def test_iteration_with_a_narrow_block():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 40)) * np.linspace(2, 1, 40)
    x -= x.mean(axis=0)
    v = x.T @ x / 500
    directions, values, rounds = whitening.top_directions(lambda q: v @ q, 40, np.trace(v), width=12)
    assert rounds > 2 and np.allclose(values, np.linalg.eigvalsh(v)[::-1][:4], rtol=1e-13)
    assert np.linalg.norm(v @ directions - directions * values, axis=0).max() <= 1e-12 * values[0]
    with pytest.raises(RuntimeError, match="not certified"):
        whitening.top_directions(lambda q: v @ q + 1e-3 * rng.normal(size=q.shape), 40, np.trace(v), width=12, degree=2)


def test_query_whitening(spark):
    given = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    check_whitening([(r["vec_id"], r["embedding"]) for r in given.collect()], QUERIES["op12_whitening"](spark, SMALL).collect())


# Katz


class Model:
    """Katz's model of bigrams in plain Python; only the discount ratios are shared with the operator."""

    def __init__(self, texts):
        self.one, self.two = Counter(), Counter()
        for words in texts:
            self.one.update(words[1:])
            self.two.update(zip(words, words[1:]))
        few = [[sum(v == r for v in c.values()) for r in range(1, 7)] for c in (self.one, self.two)]
        self.ratios = [katz.discounts(c) for c in few]
        self.n = self.one.total()
        kept = sum(self.star(c, 0) for c in self.one.values())
        self.mass = max(self.n, kept + 0.5)
        self.unseen = 1 - kept / self.mass
        self.after = defaultdict(dict)
        for (a, b), c in self.two.items():
            self.after[a][b] = c

    def star(self, count, order):
        return count * self.ratios[order][count] if count <= 5 else count

    def alone(self, word):
        return self.star(self.one[word], 0) / self.mass if self.one[word] else self.unseen

    def given(self, context, word):
        seen = self.after.get(context)
        if not seen:
            return self.alone(word)
        kept = sum(self.star(c, 1) for c in seen.values())
        mass = max(sum(seen.values()), kept + 0.5)
        if word in seen:
            return self.star(seen[word], 1) / mass
        return (1 - kept / mass) / (1 - sum(map(self.alone, seen))) * self.alone(word)


def padded(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [" ", *re.findall(r"[^\x20\x09-\x0D]+", lower), ""]


def brute_scores(given):
    model = Model([padded(t) for _, t, out in given if not out])
    found = []
    for i, t, out in given:
        words = padded(t)
        base = sum(math.log10((model.one[w] + 1) / (model.n + len(model.one) + 1)) for w in words[1:])
        score = sum(math.log10(model.given(a, b)) for a, b in zip(words, words[1:]))
        found.append((i, out, len(words) - 1, sum(model.one[w] > 0 for w in words[1:]), model.n, base, score))
    return model, found


def check_scores(found, expected):
    found, expected = (sorted(x, key=lambda r: (str(r[0]), r[2], round(r[6], 6))) for x in (found, expected))
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    for mine, other in zip(found, expected):
        assert mine[5:] == pytest.approx(other[5:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("sizes", [{}, {"hot_share": 20, "bucket_tokens": 2000}])
def test_katz_scores(docs, sizes):  # noqa: F811
    given = katz.held_out_by_id(docs)
    _, expected = brute_scores([tuple(r) for r in given.collect()])
    check_scores([tuple(r) for r in katz.katz_scores(given, **sizes).collect()], expected)


def test_probabilities_sum_to_one(docs):  # noqa: F811
    model, _ = brute_scores([tuple(r) for r in katz.held_out_by_id(docs).collect()])
    for context in [*list(model.after)[:50], "never"]:
        assert sum(model.given(context, w) for w in model.one) + model.given(context, "never seen") == pytest.approx(1, abs=1e-9)


def test_katz_without_rows_or_training_rows(spark, nothing):  # noqa: F811
    assert katz.score_digest(nothing).collect() == []
    held = spark.createDataFrame([(1, "a b a", True), (None, None, True)], "doc_id long, text string, held_out boolean")
    check_scores([tuple(r) for r in katz.katz_scores(held).collect()], [(1, True, 4, 0, 0, 0.0, 0.0), (None, True, 1, 0, 0, 0.0, 0.0)])


def test_bigrams_tell_held_out_text_better_than_words(spark):
    found = QUERIES["op13_katz_scores"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r["score"] for r in found) > 0.8 * sum(r["base_score"] for r in found)


def test_query_katz(spark):
    given = katz.held_out_by_id(documents(spark, SMALL))
    check_scores([tuple(r) for r in QUERIES["op13_katz_scores"](spark, SMALL).collect()], brute_scores([tuple(r) for r in given.collect()])[1])


def test_discounts():
    assert list(katz.discounts([0] * 6)) == pytest.approx([0, 0.5, 0.75, 2.5 / 3, 3.5 / 4, 0.9])
    counts = [1000, 400, 220, 140, 95, 70]
    common = 6 * 70 / 1000
    assert katz.discounts(counts)[1:] == pytest.approx([((r + 1) * counts[r] / (r * counts[r - 1]) - common) / (1 - common) for r in range(1, 6)])
