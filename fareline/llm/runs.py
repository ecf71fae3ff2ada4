"""Periodic runs of words, located by block convolution.

A run with period q matches itself at distance q on all but its last q words. That
stretch holds a whole block of B words, B <= (q + 1) / 2, wherever blocks of B words are
laid. So at each dyadic B every block is compared with the window that follows it at
the distances 2B - 1 to 4B - 2: the sum of squared differences of word numbers is 0 just
where the block occurs again. The products in it come from a number-theoretic transform
over as many primes as the greatest possible sum needs, so a residue of 0 under all of
them is an exact 0. Blocks in line that occur again at one distance are a seed, which is
less than a block short on either side; word by word comparison settles its ends.

A transform is a product with the matrix of root powers, in doubles: residues are kept
below half of a 23-bit prime, so sums over 256 terms stay below 2^53 and are exact.
Longer transforms are split into rows and columns of that size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import map_columns

#: Words of a run at least, and repeats of its period.
LEAST_WORDS, LEAST_REPEATS = 12, 2
#: Primes m 2^18 + 1 below 2^23.
PRIMES = (7340033, 5767169, 786433)
#: Words of the largest block; longer distances are further windows of it.
LARGEST_BLOCK = 1 << 16
DENSE = 256
#: Words compared together, from several texts or one, and numbers held by a transform.
BATCH_WORDS, BATCH_NUMBERS = 1 << 18, 1 << 20

Run = tuple[int, int, int]


def _reduced(x: np.ndarray, prime: int) -> np.ndarray:
    """Residues of least magnitude of exact integers below 2^53."""
    return x - np.rint(x * (1 / prime)) * prime


@lru_cache
def _root(prime: int) -> int:
    """A generator of the residues' multiplication."""
    odd = (prime - 1) >> 18
    while odd % 2 == 0:
        odd >>= 1
    factors = [2, *[f for f in range(3, odd + 1) if odd % f == 0]]
    return next(g for g in range(2, prime) if all(pow(g, (prime - 1) // f, prime) != 1 for f in factors))


@lru_cache(maxsize=256)
def _powers(prime: int, size: int, sign: int) -> np.ndarray:
    step = pow(_root(prime), sign * (prime - 1) // size, prime)
    made = np.ones(1, np.int64)
    while len(made) < size:
        made = np.concatenate((made, made * pow(step, len(made), prime) % prime))
    return made


@lru_cache(maxsize=64)
def _matrix(prime: int, rows: int, columns: int, size: int, sign: int) -> np.ndarray:
    """Powers a c of the root of order `size`, for a below rows and c below columns."""
    at = np.outer(np.arange(rows), np.arange(columns)) % size
    return _reduced(_powers(prime, size, sign)[at].astype(np.float64), prime)


def transform(x: np.ndarray, prime: int, sign: int) -> np.ndarray:
    """Each row's number-theoretic transform; with sign -1 its inverse times its length."""
    count, size = x.shape
    if size <= DENSE:
        return _reduced(x @ _matrix(prime, size, size, size, sign), prime)
    rest = size // DENSE
    by_rows = _reduced(_matrix(prime, DENSE, DENSE, DENSE, sign) @ x.reshape(count, DENSE, rest), prime)
    by_rows = _reduced(by_rows * _matrix(prime, DENSE, rest, size, sign), prime)
    both = transform(by_rows.reshape(-1, rest), prime, sign).reshape(count, DENSE, rest)
    return both.transpose(0, 2, 1).reshape(count, size)


def occurrences(numbers: np.ndarray, blocks: np.ndarray, block: int, first: int, low: int, high: int) -> np.ndarray:
    """Whether each block occurs again at each distance from low to high.

    The window is the four blocks from the first-th after the block on; numbers must
    reach that far.
    """
    size = 4 * block
    rows = numbers.reshape(-1, block)
    before = np.concatenate(([0], np.cumsum(numbers * numbers)))
    greatest = int(numbers.max(initial=0)) ** 2 * block
    primes, reach = [], 1
    for prime in PRIMES:
        if reach <= greatest:
            primes.append(prime)
            reach *= prime
    distances = np.arange(low, high + 1)
    found = np.empty((len(blocks), len(distances)), bool)
    step = max(1, BATCH_NUMBERS // size)
    for start in range(0, len(blocks), step):
        some = blocks[start : start + step]
        own = np.zeros((len(some), size))
        own[:, :block] = rows[some]
        window = rows[some[:, None] + first + np.arange(4)].reshape(len(some), size).astype(np.float64)
        at = (some * block)[:, None] + distances
        squares = before[at + block] - before[at] + (before[(some + 1) * block] - before[some * block])[:, None]
        same = np.ones((len(some), len(distances)), bool)
        for prime in primes or PRIMES[:1]:
            product = _reduced(transform(_reduced(window, prime), prime, 1) * transform(_reduced(own, prime), prime, -1), prime)
            twice = _reduced(transform(product, prime, -1)[:, distances - first * block] * (2 * pow(size, -1, prime) % prime), prime)
            same &= _reduced(squares % prime - twice, prime) == 0
        found[start : start + step] = same
    return found


def _scales(longest: int) -> Iterator[tuple[int, int, int, int]]:
    """Block size, first block of the window, and the distances from low to high."""
    yield 2, 0, 1, 6
    block, first, low = 4, 1, 7
    while LEAST_REPEATS * low <= longest:
        yield block, first, low, low + 2 * block - 1
        low += 2 * block
        if block < LARGEST_BLOCK:
            block *= 2
        else:
            first += 2


def _steps(numbers: np.ndarray, at: np.ndarray, distance: np.ndarray, step: int) -> np.ndarray:
    """How many words from `at` on, in steps of 1 or -1, equal those at the distance; 0 equals nothing."""
    count = np.zeros(len(at), np.int64)
    alive, width = np.arange(len(at)), 16
    while len(alive):
        i = (at[alive] + step * count[alive])[:, None] + step * np.arange(width)
        i = np.clip(i, 0, len(numbers) - 1)
        word = numbers[i]
        same = (word != 0) & (word == numbers[np.minimum(i + distance[alive][:, None], len(numbers) - 1)])
        full = same.all(axis=1)
        count[alive] += np.where(full, width, same.argmin(axis=1))
        alive = alive[full]
        width = max(16, min(4 * width, BATCH_NUMBERS // max(1, len(alive))))
    return count


def _has_shorter_period(numbers: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch of at least two periods has a period that divides this one."""
    rest, factor, factors = period, 2, []
    while factor * factor <= rest:
        if rest % factor == 0:
            factors.append(factor)
            while rest % factor == 0:
                rest //= factor
        factor += 1
    if rest > 1:
        factors.append(rest)
    first = numbers[start : start + period]
    return any(np.array_equal(first, numbers[start + period // f : start + period // f + period]) for f in factors)


def runs_of_numbers(numbers: np.ndarray, text: np.ndarray, again: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows start, end, period of all runs in a line of texts.

    numbers: a number above 0 for each word that its text repeats, 0 for all others and
    between texts, at both ends too. text: the text of each place. again: how far on the
    word occurs next. sizes: the words of each place's text.
    """
    found = np.empty((0, 3), np.int64)
    for block, first, low, high in _scales(int(sizes.max(initial=0))):
        least = max(LEAST_WORDS, LEAST_REPEATS * low)
        able = (numbers != 0) & (again <= high) & (sizes >= least)
        padded = np.zeros((-(-len(numbers) // block) + first + 5) * block, np.int64)
        padded[: len(numbers)] = numbers
        whole = np.zeros(len(padded), bool)
        whole[: len(numbers)] = able
        blocks = np.flatnonzero(whole.reshape(-1, block).all(axis=1))
        if not len(blocks):
            continue
        same = occurrences(padded, blocks, block, first, low, high)
        # A seed inside a run whose period divides its distance is that run.
        for start, end, period in found[found[:, 1] - found[:, 0] >= low + block]:
            for distance in range(-(-low // period) * period, high + 1, period):
                inside = np.searchsorted(blocks, [-(-start // block), (end - distance) // block])
                same[inside[0] : inside[1], distance - low] = False
        distance, place = np.nonzero(same.T)
        distance, place = distance + low, blocks[place]
        kept = text[np.minimum(place * block + distance, len(text) - 1)] == text[place * block]
        distance, place = distance[kept], place[kept]
        if not len(place):
            continue
        new = np.concatenate(([True], (np.diff(distance) != 0) | (np.diff(place) != 1)))
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(place)))
        distance, start = distance[at], place[at] * block
        end = start + count * block
        hopeful = end - start + 2 * (block - 1) >= np.maximum(distance, LEAST_WORDS - distance)
        distance, start, end = distance[hopeful], start[hopeful], end[hopeful]
        start = start - _steps(numbers, start - 1, distance, -1)
        end = end + _steps(numbers, end, distance, 1) + distance
        long = end - start >= np.maximum(LEAST_WORDS, LEAST_REPEATS * distance)
        made = np.stack((start, end, distance), axis=1)[long]
        real = [not _has_shorter_period(numbers, s, q) for s, _, q in made]
        found = np.concatenate((found, made[np.array(real, bool)]))
    return found


def find_runs(texts: list[list]) -> list[list[Run]]:
    """Start, length and period of all runs of each list of words, by start, then period."""
    counts = np.array([len(words) for words in texts], np.int64)
    total = int(counts.sum())
    if total == 0:
        return [[] for _ in texts]
    known = {word: n for n, word in enumerate({word for words in texts for word in words})}
    word = np.fromiter((known[word] for words in texts for word in words), np.int64, total)
    text = np.repeat(np.arange(len(texts)), counts)
    # Occurrences of a word in a text stand together, in their order.
    key = text * len(known) + word
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    again = np.full(total, np.iinfo(np.int64).max)
    again[order[:-1][same]] = np.diff(order)[same]
    opens = np.concatenate(([True], ~same))
    repeats = np.concatenate((same, [False]))
    rank = np.cumsum(opens & repeats)
    of_text = np.where(opens & repeats, text[order], -1)
    before = np.cumsum(np.bincount(of_text[of_text >= 0], minlength=len(texts)))
    before = np.concatenate(([0], before[:-1]))
    numbers = np.zeros(total, np.int64)
    member = repeats | ~opens
    numbers[order[member]] = (rank - before[text[order]])[member]
    # One place between texts and at both ends.
    starts = np.concatenate(([0], np.cumsum(counts)[:-1])) + np.arange(len(texts)) + 1
    place = np.arange(total) + text + 1
    line = np.zeros(total + len(texts) + 1, np.int64)
    line[place] = numbers
    line_text, line_again, line_sizes = np.full(len(line), -1), np.zeros_like(line), np.zeros_like(line)
    line_text[place], line_again[place], line_sizes[place] = text, again, counts[text]
    runs: list[list[Run]] = [[] for _ in texts]
    for start, end, period in runs_of_numbers(line, line_text, line_again, line_sizes).tolist():
        n = int(line_text[start])
        runs[n].append((start - int(starts[n]), end - start, period))
    return [sorted(found, key=lambda run: (run[0], run[2])) for found in runs]


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by one space, of each run only its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([word for word, dropped in zip(words, np.cumsum(change)) if not dropped])


def _grouped(texts: list[list[bytes]]) -> Iterator[list[list[bytes]]]:
    """Texts in turn, as many together as have BATCH_WORDS words, or one longer one."""
    group, size = [], 0
    for words in texts:
        if group and size + len(words) > BATCH_WORDS:
            yield group
            group, size = [], 0
        group.append(words)
        size += len(words)
    if group:
        yield group


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, runs, collapsed) for every row.

    Words are what ASCII white space separates, numbered from 0. runs has the start,
    length and period of each stretch of at least 12 words that repeats its smallest
    period at least twice and that no neighbouring word extends, by start, then period.
    collapsed is the text's words joined by one space, of each run only its first period.
    A null or empty text has no runs and collapses to nothing; a table without rows gives
    none. Texts are independent, of any length: they meet in a task as their input split
    has them, and a long one is compared by itself. Repeated rows give repeated results,
    null ids stay, ties don't arise, and other columns, whatever their names, aren't read.
    """
    schema = "id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string".format(
        kind=docs.select(id_col).dtypes[0][1]
    )

    def make():
        def work(ids: list, texts: list) -> list[list]:
            split = [(text or "").encode("utf-8", "surrogatepass").split() for text in texts]
            found = [runs for group in _grouped(split) for runs in find_runs(group)]
            named = [[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found]
            joined = [collapsed(words, runs).decode("utf-8", "surrogatepass") for words, runs in zip(split, found)]
            return [ids, [len(words) for words in split], named, joined]

        return work

    return map_columns(docs, [id_col, text_col], schema, make).withColumnRenamed("id", id_col)


def with_planted_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text_col), one text in ten made periodic from a word on; which and how, its id decides."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")
    h = F.crc32(F.col(id_col).cast("string"))
    g = F.floor(h / 10)
    plan = docs.select(id_col, text.alias(text_col), F.when(h % 10 == 0, words).alias("words"), g.alias("g"))
    n = F.size("words")
    plan = plan.withColumn("a", F.when(n > 0, (F.col("g") % n).cast("int")))
    plan = plan.withColumn("p", F.expr("cast(1 + (size(words) - a) div (3 + g % 8) as int)"))
    periodic = F.expr("array_join(transform(words, (w, i) -> if(i >= a, words[a + (i - a) % p], w)), ' ')")
    return plan.select(id_col, F.when(F.col("a").isNotNull(), periodic).otherwise(F.col(text_col)).alias(text_col))


def run_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period), and digests."""
    order = F.array_sort(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    first = found.select("*", F.get(order, F.lit(0)).alias("_longest"))
    length, period = -F.col("_longest.l"), F.col("_longest.p")
    return first.select(
        id_col,
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_longest.s").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
