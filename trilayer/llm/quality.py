"""Quality rules: a linear-chain conditional random field marks the lines of a text as content or boilerplate, and the
share of content words decides whether the document stays.

The field is trained here, on the lines of a bounded sample of labelled documents: lines of good documents are content,
lines of bad ones boilerplate.  Labels are of whole documents, so stretches of good and bad ones are composed into
sequences in which the state changes; transitions are learnt from those.  Decoding is Viterbi's, over all lines of every
whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilayer.llm.common import arrow_pass, id_and_text, text_hash, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
#: Documents that the field is fitted on, and the code points that each of them may have.
SAMPLE_DOCUMENTS, SAMPLE_CHARS = 600, 10_000
#: Share of words in content lines from which a document stays.
CONTENT_SHARE = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
STEPS, RATE, PENALTY = 400, 0.5, 1e-3
#: Training sequences: lines of the longest stretch in one state, and lines from which a sequence is full.
STRETCH, SEQUENCE = 8, 64
FEATURES = ("bias", "words", "word length", "symbols", "capitals", "digits", "exclamations", "repeated", "sentence end", "short", "same words")


@dataclass(frozen=True)
class LineField:
    """Weights of the boilerplate state (the content state's are zero) and of the transitions from state to state."""

    state: np.ndarray
    step: np.ndarray


#: Where there are no labels of both kinds: symbols, capitals, exclamation marks and repeated lines speak for boilerplate.
UNTRAINED = LineField(
    np.array([-2.0, 0.0, 0.0, 20.0, 6.0, 4.0, 20.0, 3.0, -0.5, 0.5, 4.0]), np.array([[0.5, -0.5], [-0.5, 0.5]])
)


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Per line with a word: its features, and its number of words."""
    rows, sizes, seen = [], [], set()
    for line in text.split("\n"):
        words = WORD.findall(line)
        if not words:
            continue
        chars, n = sum(map(len, words)), len(words)
        letters_up = sum(map(line.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        rows.append(
            (
                1.0,
                min(n, 100) / 100,
                min(chars / n, 20) / 20,
                sum(map(line.count, SYMBOLS)) / chars,
                letters_up / chars,
                sum(map(line.count, "0123456789")) / chars,
                line.count("!") / chars,
                float(line in seen),
                float(line.rstrip()[-1:] in ".!?:;"),
                float(n < 4),
                1 - len(set(words)) / n,
            )
        )
        sizes.append(n)
        seen.add(line)
    return np.array(rows, dtype="float64").reshape(-1, len(FEATURES)), np.array(sizes, dtype="int64")


def viterbi(features: np.ndarray, field: LineField) -> np.ndarray:
    """The most likely states of a text's lines; of equals, content.  True is boilerplate."""
    scores = (features @ field.state).tolist()
    (stay, enter), (leave, remain) = field.step.tolist()
    content, boiler, came = 0.0, 0.0, []
    for i, score in enumerate(scores):
        if i:
            stays, leaves, enters, remains = content + stay, boiler + leave, content + enter, boiler + remain
            came.append((leaves > stays, remains > enters))
            content, boiler = max(stays, leaves), max(enters, remains)
        boiler += score
    states = [boiler > content] if scores else []
    for back in reversed(came):
        states.append(back[1] if states[-1] else back[0])
    return np.array(states[::-1], dtype=bool)


def composed(lines: list[np.ndarray], bad: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sequences of lines and their states, every given line once.

    Texts are cut to stretches of 1 to `STRETCH` lines; those of either state, in random order, are spread evenly over the
    whole, which is cut after the stretch that makes a sequence `SEQUENCE` lines long.  The same input gives the same.
    """
    random = np.random.default_rng(0)
    dealt = []
    for state in (0, 1):
        stretches = []
        for rows in (rows for rows, kind in zip(lines, bad) if kind == state):
            at = 0
            while at < len(rows):
                end = at + int(random.integers(1, STRETCH + 1))
                stretches.append(rows[at:end])
                at = end
        order = random.permutation(len(stretches))
        dealt += [((place + 0.5) / len(order), state, stretches[i]) for place, i in enumerate(order)]
    dealt.sort(key=lambda item: item[:2])
    sequences, open_rows, open_states = [], [], []
    for i, (_, state, rows) in enumerate(dealt):
        open_rows.append(rows)
        open_states += [state] * len(rows)
        if len(open_states) >= SEQUENCE or i == len(dealt) - 1:
            sequences.append((np.concatenate(open_rows), np.array(open_states)))
            open_rows, open_states = [], []
    return sequences


def expected(x: np.ndarray, there: np.ndarray, field: LineField) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward sums over texts padded to the longest: per text the log of the sum over all paths, per line
    the probability of boilerplate, and the expected number of steps from state to state."""
    n, longest = there.shape
    step, pairs = field.step, there[:, 1:]
    emit = np.stack([np.zeros((n, longest)), x @ field.state], axis=2)
    ahead, back = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
    ahead[:, 0] = emit[:, 0]
    for t in range(1, longest):
        inner = np.logaddexp(ahead[:, t - 1, 0, None] + step[0], ahead[:, t - 1, 1, None] + step[1]) + emit[:, t]
        ahead[:, t] = np.where(there[:, t, None], inner, ahead[:, t - 1])
    for t in range(longest - 2, -1, -1):
        after = emit[:, t + 1] + back[:, t + 1]
        inner = np.logaddexp(step[:, 0] + after[:, 0, None], step[:, 1] + after[:, 1, None])
        back[:, t] = np.where(there[:, t + 1, None], inner, 0.0)
    whole = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
    likely = np.exp(ahead[:, :, 1] + back[:, :, 1] - whole[:, None]) * there
    joint = ahead[:, :-1, :, None] + step + (emit + back)[:, 1:, None, :] - whole[:, None, None, None]
    return whole, likely, (np.exp(np.minimum(joint, 0)) * pairs[:, :, None, None]).sum(axis=(0, 1))


def fit(lines: list[np.ndarray], bad: list[int]) -> LineField:
    """Penalised maximum likelihood by gradient steps on the composed sequences, all at once."""
    if len(set(bad)) < 2:
        return UNTRAINED
    sequences = composed(lines, bad)
    n, longest = len(sequences), max(len(states) for _, states in sequences)
    x = np.zeros((n, longest, len(FEATURES)))
    there, y = np.zeros((n, longest), dtype=bool), np.zeros((n, longest), dtype="int64")
    for i, (rows, states) in enumerate(sequences):
        x[i, : len(rows)], there[i, : len(rows)], y[i, : len(rows)] = rows, True, states
    total, pairs = there.sum(), there[:, 1:]
    state, step = np.zeros(len(FEATURES)), np.zeros((2, 2))
    speed_state, speed_step = np.zeros_like(state), np.zeros_like(step)
    seen_step = np.array([[(pairs & (y[:, 1:] == b) & (y[:, :-1] == a)).sum() for b in (0, 1)] for a in (0, 1)])
    seen_state = np.einsum("nlf,nl->f", x, there * y)
    for _ in range(STEPS):
        _, likely, likely_step = expected(x, there, LineField(state, step))
        speed_state = 0.9 * speed_state + RATE * ((seen_state - np.einsum("nlf,nl->f", x, likely)) / total - PENALTY * state)
        speed_step = 0.9 * speed_step + RATE * ((seen_step - likely_step) / total - PENALTY * step)
        state, step = state + speed_state, step + speed_step
    return LineField(state, step)


def fit_on_labels(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS, chars: int = SAMPLE_CHARS) -> LineField:
    """Fit on at most `sample` labelled documents, half of them good and half bad, picked by a hash of their ids among
    those of at most `chars` code points.  Of rows that share an id the one with the smallest text hash counts.  Labels other than 0 and 1, and texts without words, are left out."""
    rated = labels.select(F.col("doc_id").cast("long").alias("rated_id"), F.col("quality").cast("int").alias("rating")).where("rating in (0, 1)")
    rated = rated.groupBy("rated_id").agg(F.min("rating").alias("rating"))
    rows = id_and_text(docs).where(F.length("text") <= chars)
    # Ids meet the labels, texts stay where they are: the picked ids, `sample` at most, go back to the scan as a filter.
    ids = rows.select("doc_id").join(rated, F.col("doc_id") == F.col("rated_id")).select("doc_id", "rating").distinct()
    rating_of: dict[int, int] = {}
    for rating in (0, 1):
        first = ids.where(F.col("rating") == rating).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2)
        rating_of |= {row["doc_id"]: rating for row in first.collect()}
    picked = rows.where(F.col("doc_id").isin(list(rating_of))).groupBy("doc_id").agg(F.min_by("text", text_hash(F.col("text"))).alias("text"))

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines = [line_features(text)[0].ravel() for text in texts(batch)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.list_(pa.float64()))], names=["doc_id", "lines"])

    found = arrow_pass(picked, convert, "doc_id long, lines array<double>").collect() if rating_of else []
    found = sorted((row["doc_id"], row["lines"]) for row in found if row["lines"])
    return fit([np.array(lines).reshape(-1, len(FEATURES)) for _, lines in found], [1 - rating_of[doc] for doc, _ in found])


def repeated_words(words: list[str], window: int = 3) -> int:
    """Words inside windows of `window` words that the text holds twice or more, the first ones included."""
    if len(words) <= window:
        return 0
    numbers: dict[str, int] = {}
    at = np.array([numbers.setdefault(word, len(numbers)) for word in words], dtype="int64")
    key = at[: len(at) - window + 1]
    for shift in range(1, window):
        # Renumbered after each word, so that the product stays in range for any text.
        if shift > 1:
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(numbers) + at[shift : len(at) - window + 1 + shift]
    _, place, times = np.unique(key, return_inverse=True, return_counts=True)
    twice = times[place] > 1
    covered = np.zeros(len(words) + 1, dtype="int64")
    covered[: len(twice)] += twice
    covered[window : window + len(twice)] -= twice
    return int((np.cumsum(covered[:-1]) > 0).sum())


@dataclass(frozen=True)
class Verdict:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    base_failed: bool
    kept: bool
    content_share: float


def judge(text: str, field: LineField, share: float = CONTENT_SHARE) -> Verdict:
    words = WORD.findall(text)
    n, repeats = len(words), repeated_words(words)
    with_word = Counter(line for line in text.split("\n") if line and WORD.search(line))
    failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
    features, sizes = line_features(text)
    content = float(sizes[~viterbi(features, field)].sum()) / max(n, 1)
    return Verdict(
        n, sum(map(len, words)), sum(map(text.count, SYMBOLS)), with_word.total() - len(with_word), repeats, failed, not failed and content >= share, content
    )


def quality_digest(docs: DataFrame, field: LineField) -> DataFrame:
    """Per row of `docs`: doc_id, the counts of its whole text, base_failed, kept and the share of content words.

    A null or empty text has no words and fails.  Rows with equal ids or texts are judged one by one.
    """
    kinds = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "base_failed": "boolean", "kept": "boolean", "content_share": "double"}

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        verdicts = [judge(text, field) for text in texts(batch)]
        arrow = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
        columns = [pa.array([getattr(v, name) for v in verdicts], arrow[kind]) for name, kind in kinds.items()]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *kinds])

    return arrow_pass(id_and_text(docs), convert, "doc_id long, " + ", ".join(f"{n} {k}" for n, k in kinds.items()))


def good_documents(docs: DataFrame, field: LineField) -> DataFrame:
    """The rows of `docs` that are kept, all columns."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([judge(text, field).kept for text in texts(batch)], pa.bool_()))

    plain = docs.withColumn("text", F.col("text").cast("string"))
    return arrow_pass(plain, convert, plain.schema)
