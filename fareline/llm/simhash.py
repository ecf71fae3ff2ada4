"""SimHash near-duplicates by vantage-point trees over Hamming space.

Distinct fingerprints are dealt to the leaves of a vantage-point tree that is built from
a bounded sample: each inner node splits at a distance from its vantage point. A
fingerprint's own leaf is where it falls; it also visits every leaf that a ball of the
link radius around it reaches, by the triangle inequality. A leaf's own fingerprints
against all its visitors therefore gives every link, and leaves are independent. Inside
a leaf the same split is applied again, down to small blocks that are compared bit by
bit. The sample only shapes the tree; no link depends on it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.cells import LocalLinks, grid
from fareline.llm.common import components, durable, map_columns

SEED = 42
SHINGLE_WORDS = 3
RADIUS = 3
SAMPLE = 8192
#: Fingerprints of a leaf, and the most leaves a tree has. Copies to other leaves cost a
#: shuffle and pruning inside a leaf doesn't, so leaves are large.
LEAF, MOST_LEAVES = 65_536, 1024
#: Own fingerprints and visitors that one task compares at once, a few megabytes.
OWN_BLOCK, VISITOR_BLOCK = 65_536, 262_144
SMALL = 96
BITS_AT_ONCE = 65_536


def fingerprint(text: str) -> int:
    """Bits set in over half of the hashes of the text's word shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE_WORDS:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: -SHINGLE_WORDS]))
    hash_ = xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), (ends[SHINGLE_WORDS - 1 :] - 1).tolist(), strict=True)
    hashes = np.array([hash_(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BITS_AT_ONCE):
        part = hashes[at : at + BITS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def distances(points: np.ndarray, point: int) -> np.ndarray:
    return np.bitwise_count(points ^ np.uint64(point)).astype(np.int8)


class VantageTree:
    """Inner nodes (vantage point, split, near child, far child) over leaf numbers."""

    def __init__(self, sample: np.ndarray, leaves: int) -> None:
        self.leaves = 0
        self._root = self._grow(np.unique(sample), leaves)

    def _grow(self, points: np.ndarray, leaves: int):
        split = _split(points) if leaves > 1 and len(points) > 1 else None
        if split is None:
            self.leaves += 1
            return self.leaves - 1
        point, middle, d = split
        near, far = points[d <= middle], points[d > middle]
        share = min(leaves - 1, max(1, round(leaves * len(near) / len(points))))
        return point, middle, self._grow(near, share), self._grow(far, leaves - share)

    def visits(self, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the point, leaf, and whether the leaf is the point's own."""
        found = []

        def walk(node, at: np.ndarray, own: np.ndarray) -> None:
            if not len(at):
                return
            if isinstance(node, int):
                found.append((at, np.full(len(at), node, np.int32), own))
                return
            point, middle, near, far = node
            d = distances(points[at], point)
            for child, reached, inside in (
                (near, d <= middle + radius, d <= middle),
                (far, d > middle - radius, d > middle),
            ):
                walk(child, at[reached], own[reached] & inside[reached])

        walk(self._root, np.arange(len(points)), np.ones(len(points), bool))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, bool)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _split(points: np.ndarray) -> tuple[int, int, np.ndarray] | None:
    """The vantage point, of a few tried, whose median leaves the fewest near its border."""
    best = None
    for at in np.linspace(0, len(points) - 1, 8, dtype=int):
        d = distances(points, int(points[at]))
        middle = int(np.median(d))
        inside = int((d <= middle).sum())
        if inside == len(points):
            middle -= 1
            inside = int((d <= middle).sum())
        if 0 < inside < len(points):
            shared = int((np.abs(d - middle) <= RADIUS).sum()) + abs(2 * inside - len(points)) // 4
            if best is None or shared < best[0]:
                best = shared, int(points[at]), middle, d
    return best and best[1:]


def near_pairs(own: np.ndarray, visitors: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of own, index of visitor) of all pairs within the radius, in blocks."""

    def join(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if not len(a) or not len(b):
            return
        split = _split(own[a]) if len(a) > SMALL and len(b) > SMALL else None
        if split is None:
            for start in range(0, len(b), 8192):
                c = b[start : start + 8192]
                for begin in range(0, len(a), 256):
                    e = a[begin : begin + 256]
                    i, j = np.nonzero(np.bitwise_count(own[e][:, None] ^ visitors[c][None, :]) <= radius)
                    yield e[i], c[j]
            return
        point, middle, da = split
        db = distances(visitors[b], point)
        yield from join(a[da <= middle], b[db <= middle + radius])
        yield from join(a[da > middle], b[db > middle - radius])

    yield from join(np.arange(len(own)), np.arange(len(visitors)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, bits): the fingerprint of every row as a signed long; null texts have 0."""
    kind = docs.select(id_col).dtypes[0][1]

    def make():
        def work(keys: list, texts: list) -> list[list]:
            bits = np.array([fingerprint(text or "") for text in texts], dtype=np.uint64)
            return [keys, bits.astype(np.int64).tolist()]

        return work

    return map_columns(docs, [id_col, text_col], f"doc_id {kind}, bits long", make).withColumnRenamed("doc_id", id_col)


def hamming_components(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(node, root) of all nodes linked to another; points: bits, node, one row each, durable."""
    spark = points.sparkSession
    count = points.count()
    leaves = min(MOST_LEAVES, max(1, count // LEAF))
    sample = points.select("bits").orderBy(F.xxhash64("bits"), "bits").limit(SAMPLE).collect()
    tree = VantageTree(np.array([r.bits for r in sample], dtype=np.int64).view(np.uint64), leaves)
    shared = spark.sparkContext.broadcast(tree)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            at, leaf, own = shared.value.visits(frame["bits"].to_numpy().view(np.uint64), radius)
            yield pd.DataFrame({
                "bits": frame["bits"].to_numpy()[at], "node": frame["node"].to_numpy()[at], "leaf": leaf, "own": own
            })

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        own, visitors = group[group["own"]], group[~group["own"]]
        links = LocalLinks(own["node"].to_numpy(), visitors["node"].to_numpy())
        pairs = near_pairs(own["bits"].to_numpy().view(np.uint64), visitors["bits"].to_numpy().view(np.uint64), radius)
        for i, j in pairs:
            links.add(i, j)
        return links.edges()

    reached = points.select("bits", "node").mapInPandas(deal, "bits long, node long, leaf int, own boolean")
    # The sizes of the leaves, which are at most MOST_LEAVES, are broadcast.
    cells = grid(durable(reached), ["leaf"], F.xxhash64("bits"), OWN_BLOCK, VISITOR_BLOCK, few_cells=True)
    return components(cells.groupBy("leaf", "a", "b").applyInPandas(compare, "a long, b long"))


def group_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS
) -> DataFrame:
    """(id_col, fingerprint, component_id) for every row.

    Rows with equal fingerprints are linked through one of them; component_id is the
    smallest id reachable by links. Texts that are null or without words have fingerprint
    zero and are linked like any other. Repeated rows have the same result each. A row
    with a null id has a fingerprint and the component of its fingerprint, but is never
    the smallest id; component_id is null where all ids are. Ids are long. Only the two
    columns are read, whatever others are called; an empty table gives no rows.
    """
    rows = durable(fingerprints(docs, id_col, text_col).withColumnRenamed(id_col, "doc_id"))
    points = durable(rows.groupBy("bits").agg(F.min("doc_id").cast("long").alias("node")))
    linked = hamming_components(points.where("node is not null"), radius)
    found = points.join(linked, "node", "left").select("bits", F.coalesce("root", "node").alias("component_id"))
    return rows.join(found, "bits").select(
        F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_of_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS
) -> DataFrame:
    """One row of each group of near copies, all its columns as they are.

    Of a group the row with the smallest id stays, nulls last, then by a 128-bit digest of
    the text; of rows equal in both any one. Rows that repeat an id with different texts,
    or have none, are told apart by their texts. Null texts and texts without words are
    near copies of each other. Columns may have any name; an empty table gives no rows.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(row, F.col(id_col).alias("id"), F.unhex(F.md5(text)).alias("digest"), text.alias("text"))
    texts = durable(fingerprints(keyed, "digest", "text").distinct())
    # A group is named by a fingerprint, so that no two share a name.
    points = durable(texts.select("bits").distinct().withColumn("node", F.col("bits")))
    linked = points.join(hamming_components(points, radius), "node", "left")
    groups = texts.join(linked.select("bits", F.coalesce("root", "node").alias("group")), "bits")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("first_id"), F.col("digest").alias("first_digest"))
    first = keyed.select("id", "digest").join(groups, "digest").groupBy("group").agg(F.min(order).alias("first")).select("first.*")
    is_first = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("digest") == F.col("first_digest"))
    kept = keyed.join(first, is_first, "left_semi").dropDuplicates(["id", "digest"])
    return kept.select(*(F.col("row")[c].alias(c) for c in docs.columns))
