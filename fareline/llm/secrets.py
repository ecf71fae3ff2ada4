"""Secret scan: known forms, and strings whose entropy is that of random characters.

A candidate is a maximal run of one character class: hexadecimal digits, letters of one
case with digits, or the alphabet of base 64. A window slides over it. The window's
Shannon entropy is log2 W - S / W, where S sums c log2 c over the counts c of its
characters; a step changes two counts, so S is kept up by differences. Where the entropy
reaches what random characters of the class have, and the window mixes letters and digits
as they do, the windows' union is a span. An allow-list takes out what looks random but
isn't secret: identifiers, counting sequences, stand-ins, paths of words.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import map_columns

#: The known forms, the least characters of what counts, in the order of KINDS.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: All else that is searched for lies in such a run.
_LONG = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")


@dataclass(frozen=True)
class CharacterClass:
    """Its candidates, and what a window of `width` characters must have."""

    name: str
    candidate: str
    width: int
    least_entropy: float
    lower: int = 0
    upper: int = 0
    digits: int = 0


#: Random windows of 20 have some 3.4 bits in base 16, 3.9 in base 36 and 4.1 in base 64.
CLASSES = (
    CharacterClass("entropy_hex", r"[0-9A-F]{20,}|[0-9a-f]{20,}", 20, 3.0, digits=4),
    CharacterClass("entropy_36", r"[0-9a-z]{20,}|[0-9A-Z]{20,}", 20, 3.6, digits=3),
    CharacterClass("entropy_64", r"[A-Za-z0-9+/_=-]{20,}", 20, 3.8, lower=3, upper=3, digits=2),
)

#: What isn't secret, matched within a candidate: a span that overlaps one goes.
ALLOWED = (
    # Identifiers that are made to be told.
    r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
    # Stand-ins.
    r"(?i)example|sample|dummy|placeholder|changeme|your[_-]|xxxx|redacted",
    # Alphabets and keyboards.
    r"(?i)abcdefgh|qwertyui|012345678|987654321",
    # Paths and compounds of words: three parts of letters in a row.
    r"(?:(?<![A-Za-z0-9])[A-Za-z]{2,}[/_=-]){2}[A-Za-z]{2,}(?![A-Za-z0-9])",
)

Span = tuple[int, int, str, float | None]


def base_spans(text: str) -> list[Span]:
    """Leftmost, non-overlapping matches of each known form, by start, then in the order of KINDS."""
    found = []
    lowered = text.lower()
    long = [m.span() for m in _LONG.finditer(text)]
    if any(name in lowered for name in _NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    for kind, pattern in ((1, ACCESS), (2, HEX)):
        found += [(m.start(), kind, m.end()) for within in long for m in pattern.finditer(text, *within)]
    return [(start, end, KINDS[kind], None) for start, kind, end in sorted(found)]


def window_entropies(value: str, width: int) -> list[float]:
    """Entropy in bits of each window of the value, counts and sum kept up from one to the next."""
    weights = [0.0] + [c * math.log2(c) for c in range(1, width + 1)]
    counts: dict[str, int] = {}
    total, made = 0.0, []
    for n, new in enumerate(value):
        if n >= width:
            c = counts[value[n - width]]
            total += weights[c - 1] - weights[c]
            counts[value[n - width]] = c - 1
        c = counts.get(new, 0)
        total += weights[c + 1] - weights[c]
        counts[new] = c + 1
        if n >= width - 1:
            made.append(math.log2(width) - total / width)
    return made


def _running(value: str, is_one) -> list[int]:
    sums = [0]
    for c in value:
        sums.append(sums[-1] + is_one(c))
    return sums


def random_stretches(value: str, kind: CharacterClass) -> list[tuple[int, int, float]]:
    """Start, end and highest entropy of the unions of overlapping windows that look random."""
    width = kind.width
    lower, upper, digits = (_running(value, is_one) for is_one in (str.islower, str.isupper, str.isdigit))
    found: list[tuple[int, int, float]] = []
    for at, entropy in enumerate(window_entropies(value, width)):
        end = at + width
        mixed = (
            lower[end] - lower[at] >= kind.lower
            and upper[end] - upper[at] >= kind.upper
            and kind.digits <= digits[end] - digits[at] < width
        )
        # The sum drifts by rounding only, some 1e-12 in a million steps.
        if mixed and entropy >= kind.least_entropy - 1e-9:
            if found and at <= found[-1][1]:
                found[-1] = (found[-1][0], end, max(found[-1][2], entropy))
            else:
                found.append((at, end, entropy))
    return found


class _Disjoint:
    """Intervals, overlapping ones as one, in order."""

    def __init__(self, spans: Iterable[tuple[int, int]]) -> None:
        self._starts: list[int] = []
        self._ends: list[int] = []
        for start, end in sorted(spans):
            if self._ends and start < self._ends[-1]:
                self._ends[-1] = max(self._ends[-1], end)
            else:
                self._starts.append(start)
                self._ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        at = bisect_right(self._ends, start)
        return at < len(self._starts) and self._starts[at] < end

    def add(self, start: int, end: int) -> None:
        """Adds an interval that meets none."""
        at = bisect_right(self._ends, start)
        self._starts.insert(at, start)
        self._ends.insert(at, end)


class SecretFinder:
    """Spans of one text after another."""

    def __init__(self, classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> None:
        self._classes = [(kind, re.compile(rf"(?:{kind.candidate})", re.ASCII)) for kind in classes]
        self._allowed = [re.compile(pattern, re.ASCII) for pattern in allowed]

    def find(self, text: str) -> tuple[list[Span], list[Span]]:
        """Spans of the known forms, and random stretches that overlap neither those nor each other.

        A stretch that several classes find counts for the first of them.
        """
        base = base_spans(text)
        taken = _Disjoint((start, end) for start, end, _, _ in base)
        added: list[Span] = []
        long = [m.span() for m in _LONG.finditer(text)]
        for kind, pattern in self._classes:
            for m in (m for within in long for m in pattern.finditer(text, *within)):
                stretches = random_stretches(m[0], kind)
                allowed = _Disjoint(a.span() for p in self._allowed for a in p.finditer(m[0])) if stretches else None
                for start, end, entropy in stretches:
                    if not allowed.meets(start, end) and not taken.meets(m.start() + start, m.start() + end):
                        added.append((m.start() + start, m.start() + end, kind.name, entropy))
                        taken.add(m.start() + start, m.start() + end)
        return base, sorted(added)


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    classes: tuple[CharacterClass, ...] = CLASSES,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """(id_col, base, added) for every row: arrays of start, end, kind and entropy.

    base holds the known forms by start, then kind; added the random stretches by start,
    none of which overlaps another span. Places are code points, ends exclusive. The whole
    text is scanned; a null text counts as empty and has no spans, an empty table gives no
    rows. Repeated rows give repeated results, null ids stay, and other columns, whatever
    their names, aren't read. Rows are independent and meet in a task only as their input
    split has them.
    """
    span = "array<struct<start:long,end:long,kind:string,entropy:double>>"
    schema = f"id {docs.select(id_col).dtypes[0][1]}, base {span}, added {span}"

    def make():
        finder = SecretFinder(classes, allowed)

        def named(spans: list[Span]) -> list[dict]:
            return [{"start": s, "end": e, "kind": k, "entropy": h} for s, e, k, h in spans]

        def work(ids: list, texts: list) -> list[list]:
            found = [finder.find(text or "") for text in texts]
            return [ids, [named(base) for base, _ in found], [named(added) for _, added in found]]

        return work

    return map_columns(docs, [id_col, text_col], schema, make).withColumnRenamed("id", id_col)


def mask_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with every span of a text, overlapping ones together, replaced by [SECRET].

    All rows and columns stay in their order; a text without spans, null included, is as it was.
    """
    names = docs.columns
    place = names.index(text_col)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes)

    def make():
        finder = SecretFinder()

        def masked(text: str | None) -> str | None:
            parts, at = [], 0
            for start, end, _, _ in sorted(span for spans in finder.find(text or "") for span in spans):
                if start >= at:
                    parts += [text[at:start], "[SECRET]"]
                at = max(at, end)
            return "".join([*parts, text[at:]]) if parts else text

        return lambda *columns: [[masked(t) for t in c] if n == place else c for n, c in enumerate(columns)]

    return map_columns(docs, names, schema, make)


def secret_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the known forms, their digest, and all spans as kind:start:end, comma-joined."""
    named = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    counts = [F.size(F.filter("base", lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    # By start; an added span never starts where a known form does.
    place = lambda s: F.struct(
        s["start"], F.coalesce(F.array_position(F.lit(list(KINDS)), s["kind"]), F.lit(0)).alias("place"), s["end"], s["kind"]
    )
    every = F.array_sort(F.transform(F.concat("base", "added"), place))
    return found.select(id_col, *counts, F.sha2(named(F.col("base")), 256).alias("base_sha256"), named(every).alias("spans"))
