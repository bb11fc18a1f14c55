"""Token counts that follow edits: a tree of sums over a text's pre-tokens, updated where an edit touches it.

Merges never cross a pre-token, so a text's count is the sum over its pre-tokens.  A leaf holds some pre-tokens in a row,
their characters and tokens; inner nodes hold sums.  An edit splits and encodes anew from a little before its place on,
until a new pre-token ends where an old one ended, moved by the edit: from there on all splits are as before.  Then the
touched leaves are replaced and the sums above them are corrected.

The vocabulary's added tokens are found before any split, are pre-tokens of one token each, and end the text for what
stands before them.  Leaves can be stored with the text, and a later batch of edits loads them and encodes no text anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trilayer.llm.common import arrow_pass
from trilayer.llm.tokens import BYTE_ALPHABET, Recent

#: The byte-level vocabulary's split into pre-tokens.  Fixed value.
PRE_TOKEN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Pre-tokens of a leaf when a tree is built; what an edit writes goes to one leaf.
LEAF = 64
#: A split looks at this many characters after a pre-token at most: a run of spaces is cut before its last one if a word
#: follows.
LOOK_AHEAD = 2
#: Pre-tokens whose counts a worker keeps, in each of two generations.
MAX_COUNTS = 250_000


def pre_token_counts(path: str) -> Recent:
    """Pre-token to its number of tokens."""
    model = Tokenizer.from_file(path).model
    return Recent(lambda pre_token: len(model.tokenize(pre_token.encode().decode("latin-1").translate(BYTE_ALPHABET))), MAX_COUNTS)


@dataclass(frozen=True)
class Added:
    """The vocabulary's added tokens: the longest one that starts first is found, `longest` is a number of characters."""

    pattern: regex.Pattern
    longest: int


def added_tokens(path: str) -> Added | None:
    tokens = Tokenizer.from_file(path).get_added_tokens_decoder().values()
    if any(t.lstrip or t.rstrip or t.single_word for t in tokens):
        raise ValueError("added tokens that look at what stands beside them are not known here")
    contents = sorted((t.content for t in tokens), key=len, reverse=True)
    return Added(regex.compile("|".join(map(regex.escape, contents))), len(contents[0])) if contents else None


@dataclass(frozen=True)
class Edit:
    """Characters start to end of the text as it is when the edit comes are replaced."""

    start: int
    end: int
    new: str


class CountTree:
    """The tree of one text.  Node 1 is the root, nodes 2i and 2i + 1 are below node i, leaves are the last half.

    `leaves`, lengths and tokens of the pre-tokens as `stored_leaves` gave them for this text, spare the encoding."""

    def __init__(self, text: str, count: Callable[[str], int], added: Added | None = None, leaves: tuple[list[int], list[int]] | None = None):
        self.text, self.count, self.added, self.encoded = text, count, added, 0
        # A token that an edit forms or breaks starts so far before it at most, and what stands before it looks at it.
        self.look_ahead = max(LOOK_AHEAD, added.longest + 1 if added else 0)
        lengths, tokens = leaves or self._split(text, 0, None)
        if sum(lengths) != len(text) or len(lengths) != len(tokens):
            raise ValueError("leaves of another text")
        n_leaves = -(-len(lengths) // LEAF)
        self.width = 1 << max(n_leaves - 1, 0).bit_length()
        #: Lengths of the pre-tokens of each leaf.
        self.leaves = [lengths[i * LEAF : (i + 1) * LEAF] for i in range(n_leaves)] + [[]] * (self.width - n_leaves)
        self.leaf_tokens = [tokens[i * LEAF : (i + 1) * LEAF] for i in range(n_leaves)] + [[]] * (self.width - n_leaves)
        self.chars = np.zeros(2 * self.width, dtype="int64")
        self.tokens = np.zeros(2 * self.width, dtype="int64")
        self.chars[self.width :] = [sum(leaf) for leaf in self.leaves]
        self.tokens[self.width :] = [sum(leaf) for leaf in self.leaf_tokens]
        for sums in (self.chars, self.tokens):
            below = self.width
            while below > 1:
                sums[below // 2 : below] = sums[below : 2 * below : 2] + sums[below + 1 : 2 * below : 2]
                below //= 2

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[1])

    def _split(self, text: str, at: int, stop: Callable[[int], bool] | None) -> tuple[list[int], list[int]]:
        """Lengths and tokens of the pre-tokens from `at` on, until one's end satisfies `stop`."""
        lengths, tokens = [], []
        if stop is None:
            for start, end, is_token in self._sections(text, at):
                found = [text[start:end]] if is_token else PRE_TOKEN.findall(text, start, end)
                self.encoded += len(found)
                lengths += map(len, found)
                tokens += [1] if is_token else map(self.count, found)
            return lengths, tokens
        for start, end, is_token in self._sections(text, at):
            for a, b in [(start, end)] if is_token else (m.span() for m in PRE_TOKEN.finditer(text, start, end)):
                lengths.append(b - a)
                tokens.append(1 if is_token else self.count(text[a:b]))
                self.encoded += 1
                if stop(b):
                    return lengths, tokens
        return lengths, tokens

    def _sections(self, text: str, at: int) -> Iterator[tuple[int, int, bool]]:
        """Start and end of added tokens (True) and of what stands between them."""
        for token in self.added.pattern.finditer(text, at) if self.added else ():
            if token.start() > at:
                yield at, token.start(), False
            yield *token.span(), True
            at = token.end()
        if at < len(text):
            yield at, len(text), False

    def stored_leaves(self) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and tokens of all pre-tokens."""
        return tuple(np.fromiter(chain.from_iterable(leaves), dtype="int32") for leaves in (self.leaves, self.leaf_tokens))

    def _leaf_at(self, char: int) -> tuple[int, int]:
        """The leaf that holds a character, or the last one, and the characters before the leaf."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if char >= before + self.chars[node] and self.chars[node + 1]:
                before += int(self.chars[node])
                node += 1
        return node - self.width, before

    def _set(self, leaf: int, lengths: list[int], tokens: list[int]) -> None:
        self.leaves[leaf], self.leaf_tokens[leaf] = lengths, tokens
        node = leaf + self.width
        more_chars, more_tokens = sum(lengths) - int(self.chars[node]), sum(tokens) - int(self.tokens[node])
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2

    def apply(self, edit: Edit) -> None:
        start = min(max(edit.start, 0), len(self.text))
        end = min(max(edit.end, start), len(self.text))
        shift = len(edit.new) - (end - start)
        text = self.text[:start] + edit.new + self.text[end:]
        # The first pre-token that could have looked at the edited characters.
        first, before = self._leaf_at(max(start - self.look_ahead, 0))
        kept, at = 0, before
        while kept < len(self.leaves[first]) and at + self.leaves[first][kept] + self.look_ahead <= start:
            at += self.leaves[first][kept]
            kept += 1
        # Ends of old pre-tokens behind the edit, leaf by leaf, as far as needed.
        old_ends: set[int] = set()
        reached = [first, before]

        def old_end(place: int) -> bool:
            place -= shift
            while reached[0] < self.width and reached[1] <= place:
                position = reached[1]
                for length in self.leaves[reached[0]]:
                    position += length
                    if position >= end:
                        old_ends.add(position)
                reached[0], reached[1] = reached[0] + 1, position
            return place >= end and place in old_ends

        lengths, tokens = self._split(text, at, lambda place: place >= start + len(edit.new) and old_end(place))
        stopped = at + sum(lengths) - shift
        # Everything of the touched leaves up to there is replaced by the new pre-tokens, what stands behind stays.
        lengths = self.leaves[first][:kept] + lengths
        tokens = self.leaf_tokens[first][:kept] + tokens
        leaf, position = first, before
        while leaf < self.width and position < stopped or leaf == first:
            tail = 0
            for length in self.leaves[leaf]:
                if position >= stopped:
                    break
                position += length
                tail += 1
            rest = self.leaves[leaf][tail:], self.leaf_tokens[leaf][tail:]
            if leaf == first:
                first_rest = rest
            else:
                self._set(leaf, *rest)
            leaf += 1
        self._set(first, lengths + first_rest[0], tokens + first_rest[1])
        self.text = text


_COUNTS: dict[str, tuple[Recent, Added | None]] = {}


def _counts(path: str) -> tuple[Recent, Added | None]:
    if path not in _COUNTS:
        _COUNTS[path] = pre_token_counts(path), added_tokens(path)
    return _COUNTS[path]


def edited_trees(docs: DataFrame, path: str, loaded: bool = False) -> DataFrame:
    """`docs` has doc_id, text and edits: array of (start, end, new), applied in turn, places clipped to the text.

    Per row: doc_id, text (edited), lengths and tokens (the leaves of its tree, of each pre-token), n_pre_tokens, n_tokens
    (before the edits), n_tokens_edited, n_encoded (pre-tokens encoded for the edits), n_chars_edited.  For a later batch of
    edits, store text, lengths and tokens, join the edits and pass `loaded`: then trees are made of them, and a text is
    encoded only where its leaves are null.

    A null text is empty; null edits, null places and null replacements count as none, 0 and empty.  Rows that repeat are
    counted one by one.
    """
    numbers = ["n_pre_tokens", "n_tokens", "n_tokens_edited", "n_encoded", "n_chars_edited"]

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        count, added = _counts(path)
        rows, edited, lengths, tokens = [], [], [], []
        for i, (text, edits) in enumerate(zip(batch.column(1), batch.column(2))):
            leaves = tuple(batch.column(c)[i].as_py() for c in (3, 4)) if loaded else None
            tree = CountTree(text.as_py() or "", count.__getitem__, added, leaves if leaves and None not in leaves else None)
            n_pre_tokens, before, encoded = sum(map(len, tree.leaves)), tree.n_tokens, tree.encoded
            for e in edits.as_py() or ():
                if e:
                    tree.apply(Edit(e["start"] or 0, e["end"] or 0, e["new"] or ""))
            rows.append((n_pre_tokens, before, tree.n_tokens, tree.encoded - encoded, len(tree.text)))
            edited.append(tree.text)
            for column, leaf in zip((lengths, tokens), tree.stored_leaves()):
                column.append(leaf)
        columns = [pa.array(edited, batch.column(1).type), pa.array(lengths, pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32()))]
        columns += [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(numbers))]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "text", "lengths", "tokens", *numbers])

    wanted = {"doc_id": "long", "text": "string", "edits": "array<struct<start:long,end:long,new:string>>"}
    wanted |= {"lengths": "array<int>", "tokens": "array<int>"} if loaded else {}
    rows = docs.select(*[F.col(name).cast(kind).alias(name) for name, kind in wanted.items()])
    return arrow_pass(rows, convert, "doc_id long, text string, lengths array<int>, tokens array<int>, " + ", ".join(f"{n} long" for n in numbers))


def edited_token_counts(docs: DataFrame, path: str) -> DataFrame:
    """The numbers of `edited_trees` without texts and trees."""
    return edited_trees(docs, path).drop("text", "lengths", "tokens")


def planned_edits(docs: DataFrame) -> DataFrame:
    """`docs` with the edits of a review: a mark at the start, forty characters from the first third on masked, the last
    hundred cut."""
    n = F.length(F.coalesce(F.col("text"), F.lit("")))
    third = F.floor(n / 3)
    edits = F.array(
        F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"), F.lit("Reviewed. ").alias("new")),
        F.struct(third.alias("start"), (third + F.least(third, F.lit(40))).alias("end"), F.lit(" [removed] ").alias("new")),
        F.struct((n - 100).cast("long").alias("start"), (n + 100).cast("long").alias("end"), F.lit("").alias("new")),
    )
    return docs.select("doc_id", "text", edits.alias("edits"))
