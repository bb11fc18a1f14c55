"""License scan: fuzzy search for short notices.

A notice with at most k edits holds one of any k + 1 parts of it unchanged.  So the parts are searched as they are, each
place of a part gives a stretch of text where the notice could lie, and there the regex library matches it with bounded
errors.  Base phrases are found as whole consecutive words.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from trilayer.llm.common import arrow_pass, id_and_text, plain_words, texts

#: Phrases that count as they are.  Fixed values.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Short notices, as words, their labels and how many edits they may have.
NOTICES = (
    ("released under the mit license", "mit", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    ("licensed under the apache license version 2 0", "apache", 4),
    ("gnu general public license", "gpl", 2),
    ("gnu lesser general public license", "lgpl", 3),
    ("redistribution and use in source and binary forms", "bsd", 4),
    ("mozilla public license", "mpl", 2),
    ("creative commons attribution", "cc-by", 2),
    ("all rights reserved", "proprietary", 1),
)


@dataclass(frozen=True)
class Span:
    label: str
    first_word: int
    start: int
    end: int
    edits: int
    length: int


class Notice:
    def __init__(self, words: str, label: str, edits: int):
        self.words, self.label, self.edits = words, label, edits
        cuts = [round(i * len(words) / (edits + 1)) for i in range(edits + 2)]
        self.seeds = [(at, words[at:end]) for at, end in zip(cuts, cuts[1:])]
        # Whole words only; the best match of a stretch.
        self.pattern = regex.compile(rf"(?b)(?<=\ )(?:{regex.escape(words, literal_spaces=True)}){{e<={edits}}}(?=\ )")

    def find(self, line: str) -> list[tuple[int, int, int]]:
        """(start, end, edits) in the line of words.  Of matches that overlap, the one with the fewest edits stays, then the
        first.  Each seed opens a stretch of bounded length, so the work grows with the seeds, however dense they are."""
        stretches = set()
        for offset, seed in self.seeds:
            at = line.find(seed)
            while at >= 0:
                first = at - offset - self.edits
                stretches.add((max(first - 1, 0), min(first + len(self.words) + 2 * self.edits + 1, len(line))))
                at = line.find(seed, at + 1)
        found = {(sum(m.fuzzy_counts), *m.span()) for start, end in stretches if (m := self.pattern.search(line, start, end))}
        return sorted((start, end, edits) for edits, start, end in _apart(sorted(found)))


def _apart(found: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Of (edits, start, end), best first, those that overlap no better one."""
    taken: list[tuple[int, int]] = []
    for edits, start, end in found:
        place = bisect_left(taken, (start, end))
        if (place == 0 or taken[place - 1][1] <= start) and (place == len(taken) or end <= taken[place][0]):
            taken.insert(place, (start, end))
            yield edits, start, end


NOTICE_SEARCHES = [Notice(*notice) for notice in NOTICES]
ORIGINAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def scan(text: str) -> tuple[int, list[Span], list[Span]]:
    """Number of words, places of base phrases, fuzzy spans of notices.  Starts and ends are code points of the text."""
    words = plain_words(text)
    line = f" {b' '.join(words).decode()} "
    base, fuzzy = [], []
    for phrase, label in BASE:
        at = line.find(f" {phrase} ")
        while at >= 0:
            base.append((label, at + 1, at + 1 + len(phrase), 0, len(phrase)))
            at = line.find(f" {phrase} ", at + 1)
    for notice in NOTICE_SEARCHES:
        fuzzy += [(notice.label, start, end, edits, len(notice.words)) for start, end, edits in notice.find(line)]
    if not base and not fuzzy:
        return len(words), [], []
    starts = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), dtype="<u4") == 32)
    places = [m.span() for m in ORIGINAL_WORD.finditer(text)]

    def located(label: str, start: int, end: int, edits: int, length: int) -> Span:
        first = int(np.searchsorted(starts, start, side="right")) - 1
        last = int(np.searchsorted(starts, max(end - 1, start), side="right")) - 1
        return Span(label, first, places[first][0], places[min(last, len(places) - 1)][1], edits, length)

    return len(words), [located(*found) for found in base], [located(*found) for found in fuzzy]


def license_scan(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and the fuzzy spans.

    The score is 1 with a base phrase, else the best notice's share of unedited characters, else 0.  A null or empty text
    has no words: counts 0, no words' places, empty labels.  Rows that repeat are scanned one by one.
    """
    span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())])

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text in texts(batch):
            n, base, fuzzy = scan(text)
            places = [s.first_word for s in base]
            score = 1.0 if base else max((1.0 - s.edits / s.length for s in fuzzy), default=0.0)
            out.append(
                (
                    n, len(base), min(places, default=None), max(places, default=None),
                    ",".join(sorted({s.label for s in base})), ",".join(sorted({s.label for s in base + fuzzy})), score,
                    [{"label": s.label, "start": s.start, "end": s.end, "edits": s.edits} for s in fuzzy],
                )
            )
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(span)]
        columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return arrow_pass(
        id_and_text(docs),
        convert,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label:string,start:long,end:long,edits:long>>",
    )
