"""License scan: exact phrases, and short notices found with a bounded number of edits.

A notice of n characters may differ by k edits. Cut into k + 1 parts, one part must
occur unchanged (pigeonhole), so an Aho-Corasick automaton over all parts finds every
place where a notice can be; the regex library then matches the notice with at most k
edits around that place and gives the span and the edits.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from itertools import accumulate

import ahocorasick
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import map_columns

#: Phrases of the base scan and their labels.
PHRASES = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]

#: Short notices of the fuzzy scan, as lower-case words, and their labels.
NOTICES = [
    ("licensed under cc by", "cc-by"),
    ("creative commons attribution", "cc-by"),
    ("creative commons zero", "cc0"),
    ("gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("all rights reserved", "reserved"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("this is free and unencumbered software", "unlicense"),
]

#: One edit for so many characters of a notice.
CHARS_AN_EDIT = 10

_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256)
)


def notice_parts(notice: str, edits: int) -> list[tuple[int, str]]:
    """edits + 1 parts of near equal length, with their places."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class NoticeFinder:
    """Finds notices in normalised text (lower-case words, single spaces)."""

    def __init__(self, notices: list[tuple[str, str]], chars_an_edit: int = CHARS_AN_EDIT) -> None:
        self._notices = []
        seeds = defaultdict(list)
        for n, (notice, label) in enumerate(notices):
            edits = len(notice) // chars_an_edit
            pattern = regex.compile(f"(?e)(?:{regex.escape(notice)}){{e<={edits}}}")
            self._notices.append((label, len(notice), edits, pattern))
            for at, part in notice_parts(notice, edits):
                seeds[part].append((n, at))
        self._seeds = ahocorasick.Automaton()
        for part, places in seeds.items():
            self._seeds.add_word(part, (len(part), places))
        self._seeds.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, str, int, int]]:
        """(start, end, label, edits, length of the notice), in order of the notices."""
        windows = defaultdict(list)
        for end, (length, places) in self._seeds.iter(text):
            for n, at in places:
                _, size, edits, _ = self._notices[n]
                start = end + 1 - length - at
                low, high = max(0, start - 2 * edits), min(len(text), start + size + 2 * edits)
                if windows[n] and low <= windows[n][-1][1]:
                    windows[n][-1][1] = max(windows[n][-1][1], high)
                else:
                    windows[n].append([low, high])
        found = []
        for n in sorted(windows):
            label, size, _, pattern = self._notices[n]
            for low, high in windows[n]:
                for m in pattern.finditer(text, low, high):
                    found.append((m.start(), m.end(), label, sum(m.fuzzy_counts), size))
        return found


def scan_text(text: str | None, phrases: list[tuple[str, str]], finder: NoticeFinder) -> tuple:
    """Words, exact phrase places and notices of one text; see scan_licenses."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()
    joined = f" {b' '.join(words).decode('latin-1')} "
    # The places of the words' ends, so that a place in the text is found by bisection.
    ends = list(accumulate((len(word) + 1 for word in words), initial=0))
    places, base = [], set()
    for phrase, label in phrases:
        want = f" {phrase} "
        at = joined.find(want)
        while at >= 0:
            places.append(bisect_left(ends, at))
            base.add(label)
            at = joined.find(want, at + 1)
    notices, labels, score = [], set(base), 1.0 if places else 0.0
    for start, end, label, edits, size in sorted(set(finder.find(joined))):
        first = max(0, bisect_right(ends, start) - 1)
        last = bisect_left(ends, end - 1) - 1
        notices.append({"label": label, "first_word": first, "last_word": last, "edits": edits})
        labels.add(label)
        score = max(score, 1 - edits / size)
    return (
        len(words),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        score,
        notices,
    )


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: list[tuple[str, str]] = PHRASES,
    notices: list[tuple[str, str]] = NOTICES,
) -> DataFrame:
    """Every row with its license phrases and notices.

    Returns id_col, n_words, n_base (places of exact phrases), first_word, last_word
    (null if none), base_labels, labels (both, sorted, comma-joined, empty if none),
    score (1 for an exact phrase, else 1 - edits / length of the best notice, else 0) and
    notices (label, first and last word, edits). A null text counts as empty. Repeated
    rows give repeated results; other columns, whatever their names, are not read, and an
    empty table gives no rows. Rows are independent, so no
    rows meet in one task beyond those of its input split.
    """
    schema = (
        "doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string,"
        " labels string, score double, notices array<struct<label:string,first_word:long,last_word:long,edits:long>>"
    ).format(kind=docs.select(id_col).dtypes[0][1])

    def make():
        finder = NoticeFinder(notices)

        def work(ids: list, texts: list) -> list[list]:
            rows = [scan_text(text, phrases, finder) for text in texts]
            return [ids, *(list(column) for column in zip(*rows))]

        return work

    return map_columns(docs, [id_col, text_col], schema, make).withColumnRenamed("doc_id", id_col)
