"""Shards of near equal size by best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts form a group and stay together. What decides is a group's size
alone, so groups are counted by size class, the classes are packed, and each group takes
its shard by its rank within its class. Only the classes meet on the driver: sizes under
4096 are classes of their own, larger ones are rounded up to 12 significant bits, which
leaves at most 4096 + 51 * 2048 classes for any table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import durable, salted_rank

SIGNIFICANT_BITS = 12
RANK_SALTS = 64
ROWS_A_PART = 50_000


@dataclass
class _Node:
    key: tuple[int, int]
    left: _Node | None = None
    right: _Node | None = None
    height: int = 1


def _height(node: _Node | None) -> int:
    return node.height if node else 0


def _turned(node: _Node, left: bool) -> _Node:
    up = node.right if left else node.left
    if left:
        node.right, up.left = up.left, node
    else:
        node.left, up.right = up.right, node
    for each in (node, up):
        each.height = 1 + max(_height(each.left), _height(each.right))
    return up


def _balanced(node: _Node) -> _Node:
    node.height = 1 + max(_height(node.left), _height(node.right))
    lean = _height(node.left) - _height(node.right)
    if lean > 1:
        if _height(node.left.left) < _height(node.left.right):
            node.left = _turned(node.left, True)
        return _turned(node, False)
    if lean < -1:
        if _height(node.right.right) < _height(node.right.left):
            node.right = _turned(node.right, False)
        return _turned(node, True)
    return node


class RemainingTree:
    """Height-balanced search tree of (remaining capacity, bin)."""

    def __init__(self) -> None:
        self._root: _Node | None = None

    def add(self, key: tuple[int, int]) -> None:
        def put(node: _Node | None) -> _Node:
            if node is None:
                return _Node(key)
            if key < node.key:
                node.left = put(node.left)
            else:
                node.right = put(node.right)
            return _balanced(node)

        self._root = put(self._root)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and gives the smallest key with at least that capacity."""
        found, node = None, self._root
        while node:
            if node.key[0] >= size:
                found, node = node.key, node.left
            else:
                node = node.right
        if found:
            self._root = self._without(self._root, found)
        return found

    def _without(self, node: _Node, key: tuple[int, int]) -> _Node | None:
        if key < node.key:
            node.left = self._without(node.left, key)
        elif key > node.key:
            node.right = self._without(node.right, key)
        elif node.left is None or node.right is None:
            return node.left or node.right
        else:
            least = node.right
            while least.left:
                least = least.left
            node.key = least.key
            node.right = self._without(node.right, least.key)
        return _balanced(node)


def best_fit_decreasing(
    classes: list[tuple[int, int]], capacity: int, most: int | None = None
) -> tuple[list[tuple[int, int, int]], int] | None:
    """Packs `count` items of each (size, count) into bins of one capacity.

    Largest sizes first, each item into the bin with the least sufficient room, a new
    bin if there is none. Equal items follow each other into the same bin, as it stays
    the tightest. Returns (size, items, bin) in order and the number of bins, or None
    if an item is larger than the capacity or more than `most` bins are needed.
    """
    rooms, placed, bins = RemainingTree(), [], 0
    for size, count in sorted(classes, reverse=True):
        if size > capacity:
            return None
        while count:
            room, at = rooms.take_tightest(size) or (capacity, bins)
            if at == bins:
                bins += 1
                if most is not None and bins > most:
                    return None
            n = min(count, room // size)
            placed.append((size, n, at))
            count -= n
            rooms.add((room - n * size, at))
    return placed, bins


def even_shards(classes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """Packs into at most `shards` bins under the least capacity that allows it.

    Groups above the mean of what is left have a shard of their own, so that one giant
    group doesn't set the capacity of the others. The least capacity is searched for by
    halving; best-fit isn't monotone to the last byte, so the result is the least found.
    """
    left = sorted(classes, reverse=True)
    total, placed, first = sum(s * n for s, n in left), [], 0
    while left and shards - first > 1 and left[0][0] * (shards - first) > total:
        size, count = left[0]
        placed.append((size, 1, first))
        first, total = first + 1, total - size
        left[:1] = [(size, count - 1)] if count > 1 else []
    if not left:
        return placed
    low, high = max(left[0][0], -(-total // (shards - first))), total
    best = best_fit_decreasing(left, high, shards - first)
    while low < high:
        middle = (low + high) // 2
        tried = best_fit_decreasing(left, middle, shards - first)
        if tried:
            best, high = tried, middle
        else:
            low = middle + 1
    return placed + [(size, n, first + at) for size, n, at in best[0]]


def shard_rows(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its shard and a gapless slot in it.

    Returns id_col, size (UTF-8 bytes plus 1), text_crc32, law ("bytes": sizes as near
    equal as indivisible groups allow), shard, slot, grown_shard (null: this law has no
    growth rule). Null and empty texts are one group with size 1 and the CRC of no bytes.
    Repeated rows each have a slot. An empty table gives no rows. Other columns are not
    read, whatever their names.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = durable(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("group"),
        )
    )
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    shift = f"greatest(length(bin(bytes)) - {SIGNIFICANT_BITS}, 0)"
    rounded = f"shiftleft(shiftright(bytes + shiftleft(1L, {shift}) - 1L, {shift}), {shift})"
    groups = durable(groups.select("group", F.expr(rounded).alias("class")))
    classes = [(r["class"], r["n"]) for r in groups.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()]
    ranges, at = [], {}
    for size, count, shard in even_shards(classes, shards) if classes else []:
        first = at.get(size, 0)
        ranges.append((size, first, first + count, shard))
        at[size] = first + count
    # At most one range for each class and one more for each shard.
    plan = spark.createDataFrame(ranges, "class long, first long, next long, shard int")
    ranked = salted_rank(groups, ["class"], ["group"], F.expr(f"pmod(xxhash64(group), {RANK_SALTS})"), "rank")
    assigned = ranked.join(F.broadcast(plan), "class").where("rank >= first and rank < next").select("group", "shard")
    placed = durable(rows.join(assigned, "group").drop("group"))
    salts = max(16, placed.count() // (shards * ROWS_A_PART))
    salt = F.expr(f"pmod(xxhash64(doc_id, text_crc32, size), {salts})")
    return salted_rank(placed, ["shard"], ["doc_id", "text_crc32"], salt, "slot").select(
        F.col("doc_id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
