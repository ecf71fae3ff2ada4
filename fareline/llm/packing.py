"""Packing of tokenized documents into sequences by a grouping genetic algorithm.

A solution is a set of bins, and bins, not items, are what is inherited: a child takes
whole well-filled bins of one parent, loses the bins of the other that hold the same
items, and puts the items so displaced back: first one or two at a time in exchange for
one or two lesser ones of a bin, which fills it better (dominance), then by best fit.
Documents are dealt at random to packing problems of some thousand pieces. Each problem
is evolved on several islands that start from different packings, one Spark task group
each; between epochs every island gets the best solution of its neighbour. A problem is
evolved until its best solution has as few bins as the lengths allow, or some epochs
have brought no gain.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import durable, map_columns
from fareline.llm.words import load_words

CAPACITY = 4096
END_ID = 1
PROBLEM_PIECES = 8192
#: Epochs end at EPOCHS, or after PATIENCE of them without a gain on any island.
ISLANDS, EPOCHS, PATIENCE = 3, 8, 2
#: Children of an island in an epoch, and its members.
GENERATIONS, POPULATION = 30, 8
#: Displaced items that are tried in pairs, and items of a bin that are given in pairs.
PAIRED, GIVEN = 256, 24
#: Tasks of an epoch; more islands than that share tasks evenly.
MOST_TASKS = 10_000

Bins = list[list[int]]


def best_fit(items: list[int], lengths: np.ndarray, bins: Bins, capacity: int) -> Bins:
    """Adds items, in the order given, each to the bin with the least sufficient room."""
    rooms = sorted((capacity - int(lengths[b].sum()), n) for n, b in enumerate(bins))
    bins = [list(b) for b in bins]
    for item in items:
        length = int(lengths[item])
        at = bisect.bisect_left(rooms, (length, -1))
        if at == len(rooms):
            bins.append([item])
            bisect.insort(rooms, (capacity - length, len(bins) - 1))
        else:
            room, n = rooms.pop(at)
            bins[n].append(item)
            bisect.insort(rooms, (room - length, n))
    return bins


def fitness(bins: Bins, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first; then fuller ones, by the sum of squared fills."""
    fills = np.array([lengths[b].sum() for b in bins], dtype=float) / capacity
    return -len(bins), float((fills**2).sum())


def exchange(bins: Bins, free: list[int], lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> tuple[Bins, list[int]]:
    """Dominance: one or two items of a bin for one or two free ones that fill it better.

    Bins come in random order, each as long as it gains. What is free afterwards is less
    than before, and no item is lost. Returns the bins and the free items.
    """
    bins = [list(b) for b in bins]
    free = sorted(free, key=lambda item: lengths[item])
    for n in rng.permutation(len(bins)):
        b = bins[n]
        room = capacity - int(lengths[b].sum())
        while room and free:
            sizes = lengths[free]
            own = lengths[b]
            # Given: nothing, one item, or two; taken: one free item, or two.
            one, two = np.triu_indices(min(len(b), GIVEN), 1)
            given = np.concatenate(([0], own, own[one] + own[two]))
            single = np.searchsorted(sizes, given + room, "right") - 1
            gain = np.where(single >= 0, sizes[single] - given, 0)
            start = max(0, len(free) - PAIRED)
            tail = sizes[start:]
            other = np.searchsorted(tail, (given + room)[:, None] - tail[None, :], "right") - 1
            other = np.minimum(other, np.arange(len(tail)) - 1)
            gains = np.where(other >= 0, tail[None, :] + tail[other] - given[:, None], 0)
            best_one, best_two = int(gain.argmax()), int(gains.argmax())
            if max(gain[best_one], gains.flat[best_two]) <= 0:
                break
            if gain[best_one] >= gains.flat[best_two]:
                out, taken = best_one, [int(single[best_one])]
            else:
                out, at = divmod(best_two, len(tail))
                taken = [start + at, start + int(other[out, at])]
            places = [] if out == 0 else [out - 1] if out <= len(b) else [one[out - 1 - len(b)], two[out - 1 - len(b)]]
            back = [b[p] for p in places]
            b = [item for p, item in enumerate(b) if p not in places] + [free[t] for t in taken]
            free = [item for t, item in enumerate(free) if t not in taken]
            for item in back:
                bisect.insort(free, item, key=lambda i: lengths[i])
            room = capacity - int(lengths[b].sum())
        bins[n] = b
    return bins, free


def crossover(one: Bins, two: Bins, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> Bins:
    """Injects a run of the fuller bins of `two` into `one`, and puts back what that displaces."""
    fuller = sorted(two, key=lambda b: -int(lengths[b].sum()))
    fuller = fuller[: max(1, len(fuller) // 2)]
    first = int(rng.integers(len(fuller)))
    injected = fuller[first : first + max(1, int(rng.integers(1, len(fuller) // 2 + 2)))]
    inside = {item for b in injected for item in b}
    kept, displaced = [], []
    for b in one:
        if inside.isdisjoint(b):
            kept.append(b)
        else:
            displaced += [item for item in b if item not in inside]
    # The emptiest bins are opened as well, and one at random, which is the mutation.
    kept.sort(key=lambda b: -int(lengths[b].sum()))
    for _ in range(min(2, len(kept))):
        displaced += kept.pop()
    if kept:
        displaced += kept.pop(int(rng.integers(len(kept))))
    bins, displaced = exchange(injected + kept, displaced, lengths, capacity, rng)
    displaced.sort(key=lambda item: -int(lengths[item]))
    return best_fit(displaced, lengths, bins, capacity)


def first_population(
    lengths: np.ndarray, capacity: int, size: int, rng: np.random.Generator, shake: float = 0.2
) -> list[Bins]:
    """Best-fit decreasing, and best fit after shaking the lengths that order the items.

    shake 0 keeps the order by length, 1 makes it nearly random.
    """
    order = np.argsort(-lengths, kind="stable")
    found = [best_fit(order.tolist(), lengths, [], capacity)]
    if len(found[0]) > lower_bound(lengths, capacity):
        for _ in range(size - 1):
            shaken = np.argsort(-lengths * rng.uniform(1 - shake, 1, len(lengths)), kind="stable")
            found.append(best_fit(shaken.tolist(), lengths, [], capacity))
    return found


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The fewest bins that the lengths allow, whatever the packing.

    Items over half the capacity have a bin each. Those over capacity - k take no item of
    k or more beside them; so the items from k to half the capacity share what the other
    large ones leave, and further bins. The greatest of this over all k.
    """
    lengths = np.sort(np.asarray(lengths, dtype=np.int64))
    if not len(lengths):
        return 0
    sums = np.concatenate(([0], np.cumsum(lengths)))
    half = int(np.searchsorted(lengths, capacity // 2, "right"))
    k = np.unique(np.concatenate(([0], lengths[:half])))
    low, high = np.searchsorted(lengths, k, "left"), np.searchsorted(lengths, capacity - k, "right")
    high = np.maximum(high, half)
    beside = (high - half) * capacity - (sums[high] - sums[half])
    further = np.maximum(0, -(-(sums[half] - sums[low] - beside) // capacity))
    return int((len(lengths) - half + further).max())


def evolve(
    population: list[Bins], lengths: np.ndarray, capacity: int, generations: int, rng: np.random.Generator
) -> list[Bins]:
    """Puts a child of two members in the place of the worst, again and again; best first.

    Each parent is the better of two drawn. A child no better than the worst, or as good
    as another member, isn't taken, so that members stay different.
    """
    bound = lower_bound(lengths, capacity)
    scored = sorted(((fitness(bins, lengths, capacity), bins) for bins in population), key=lambda m: m[0], reverse=True)
    for _ in range(generations):
        if len(scored) < 2 or len(scored[0][1]) <= bound:
            break
        one, two = (int(rng.integers(len(scored), size=2).min()) for _ in range(2))
        if one == two:
            two = (one + 1) % len(scored)
        child = crossover(scored[one][1], scored[two][1], lengths, capacity, rng)
        score = fitness(child, lengths, capacity)
        if score > scored[-1][0] and all(score != other for other, _ in scored):
            scored = sorted([*scored[:-1], (score, child)], key=lambda m: m[0], reverse=True)
    return [bins for _, bins in scored]


def _coded(bins: Bins, items: int) -> bytes:
    at = np.empty(items, dtype="<i4")
    for n, b in enumerate(bins):
        at[b] = n
    return at.tobytes()


def _bins(coded: bytes) -> Bins:
    at = np.frombuffer(coded, dtype="<i4")
    order = np.argsort(at, kind="stable")
    return [b.tolist() for b in np.split(order, np.flatnonzero(np.diff(at[order])) + 1)] if len(at) else []


def token_pieces(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """(uid, doc_id, piece, start, length, ids_crc32): texts as ids and an end id, cut at the capacity.

    uid numbers rows within input splits; the result must be made durable before it is
    used, as a repeated read may number in another order.
    """
    kind = docs.select(id_col).dtypes[0][1]

    def make():
        words = load_words(tokenizer_file)
        end = struct.pack("<I", END_ID)
        context = TaskContext.get()
        uid = (context.partitionId() << 33) if context else 0

        def work(keys: list, texts: list) -> list[list]:
            nonlocal uid
            rows = []
            for key, packed in zip(keys, words.packed_all([text or "" for text in texts]), strict=True):
                ids = packed + end
                for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append((uid, key, piece, start, len(part) // 4, zlib.crc32(part)))
                    uid += 1
            return [list(column) for column in zip(*rows)]

        return work

    schema = f"uid long, doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return map_columns(docs, [id_col, text_col], schema, make)


def pack_pieces(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    problem_pieces: int = PROBLEM_PIECES,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
    generations: int = GENERATIONS,
    patience: int = PATIENCE,
) -> DataFrame:
    """Pieces (durable; unique uid, length up to the capacity) with sequence_id and offset.

    Full pieces are sequences of their own. The others are dealt by a hash of uid to as
    many problems as keep each at about `problem_pieces`, so no task holds more than a
    few thousand lengths, however the documents are distributed; each problem wastes less
    than one sequence against packing all together. Island 0 starts from best-fit
    decreasing, the others from orders that are shaken the more the higher their number.
    Epochs cost a job each for the problems that still go on. Null ids and repeated rows
    are pieces like any other. Empty input gives no rows.
    """
    full = pieces.where(F.col("length") == capacity)
    open_ = pieces.where(F.col("length") < capacity)
    problems = max(1, -(-open_.count() // problem_pieces))
    dealt = open_.withColumn("problem", F.expr(f"pmod(xxhash64(uid), {problems})").cast("int"))

    def start(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("uid")
        problem, lengths = int(group["problem"].iloc[0]), group["length"].to_numpy()
        first = first_population(lengths, capacity, 1, np.random.default_rng(problem))
        solved = len(first[0]) <= lower_bound(lengths, capacity)
        state = {"problem": problem, "lengths": lengths.astype("<i4").tobytes(), "solved": solved, "stale": 0}
        members = [_coded(b, len(lengths)) for b in first]
        return pd.DataFrame([state | {"island": i, "members": members} for i in range(1 if solved else islands)])

    def epoch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                yield pd.DataFrame([evolved(row)])

    def evolved(row: dict) -> dict:
        island = int(row["island"])
        lengths = np.frombuffer(row["lengths"], dtype="<i4").astype(np.int64)
        rng = np.random.default_rng([int(row["problem"]), island, zlib.crc32(b"".join(row["members"]))])
        population = [_bins(m) for m in row["members"]]
        before = len(population[0])
        if len(population) < POPULATION:
            shake = 0.2 + 0.8 * island / max(1, islands - 1)
            shaken = first_population(lengths, capacity, POPULATION + 1, rng, shake)[1:]
            population = shaken if island else population + shaken[1:]
        best = evolve(population, lengths, capacity, generations, rng)[:POPULATION]
        solved = len(best[0]) <= lower_bound(lengths, capacity)
        stale = 0 if len(best[0]) < before else int(row["stale"]) + 1
        return row | {"solved": solved, "stale": stale, "members": [_coded(b, len(lengths)) for b in best]}

    schema = "problem int, island int, lengths binary, solved boolean, stale int, members array<binary>"
    state = durable(dealt.select("problem", "uid", "length").groupBy("problem").applyInPandas(start, schema))
    for _ in range(epochs):
        going = state.where("not solved")
        rows = going.count()
        if not rows:
            break
        # A row is little to read and long to evolve, so rows are spread by number: a stated
        # number of partitions isn't coalesced by their bytes.
        done = durable(going.repartition(min(rows, MOST_TASKS)).mapInPandas(epoch, schema))
        # A problem ends for all its islands at once.
        ended = done.groupBy("problem").agg((F.max("solved") | (F.min("stale") >= patience)).alias("ended"))
        # Migration: the neighbour's best joins each island's members.
        elite = done.select("problem", ((F.col("island") + 1) % islands).alias("island"), F.expr("members[0]").alias("elite"))
        moved = done.join(elite, ["problem", "island"]).join(ended, "problem")
        moved = moved.withColumn("members", F.expr("array_append(members, elite)")).withColumn("solved", F.col("ended"))
        state = durable(state.where("solved").unionByName(moved.drop("elite", "ended")))

    def place(key: tuple, pieces_: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        pieces_ = pieces_.sort_values("uid")
        lengths = pieces_["length"].to_numpy()
        members = [_bins(m) for row in states["members"] for m in row]
        best = max(members, key=lambda bins: fitness(bins, lengths, capacity))
        offset, sequence = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for n, b in enumerate(best):
            sequence[b] = (int(key[0]) << 32) + n
            offset[b] = np.cumsum(lengths[b]) - lengths[b]
        return pieces_.drop(columns="problem").assign(sequence_id=sequence, offset=offset)

    columns = ", ".join(f"{name} {kind}" for name, kind in pieces.dtypes)
    placed = (
        dealt.groupBy("problem")
        .cogroup(state.groupBy("problem"))
        .applyInPandas(place, f"{columns}, sequence_id long, offset long")
    )
    own = full.withColumn("sequence_id", -1 - F.col("uid")).withColumn("offset", F.lit(0).cast("long"))
    return placed.unionByName(own)


def pack_documents(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their place in a sequence of at most 4096 tokens.

    Returns id_col, piece, start, length, ids_crc32, sequence_id, offset. A null text
    counts as empty, which is one piece of the end id. Other columns are not read.
    """
    packed = pack_pieces(durable(token_pieces(docs, tokenizer_file, id_col, text_col)))
    return packed.drop("uid").withColumnRenamed("doc_id", id_col)
