"""Exact top-k inner products with multi-resolution segment statistics.

Cut into segments of L components with means m and deviations s, two vectors satisfy
|q - x|^2 >= sum of L ((m_q - m_x)^2 + (s_q - s_x)^2), and the finer the segments, the
tighter the bound. As q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2, a lower bound of the distance
is an upper bound of the score. The norms cancel: the bound of the score is the inner
product of sqrt(L) (m, s) of both sides, one small matrix product for a block of queries
and a block of candidates. Levels are tried from coarse to fine. The pairs of the highest
finest bounds are computed first, which raises each query's k-th best score so far; of
the others, each pair whose bound doesn't reach that score is left out by itself.

Every candidate is in one shard of bounded size, which a task holds with its statistics;
the queries, the smaller side, are copied to every shard and stream by. A task hands on
the best k of each query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareline.llm.common import durable, map_columns

TOP = 20
SCALE = 64.0
QUERY_BLOCK, CANDIDATE_BLOCK = 512, 4096
#: Segments at each level, as far as they divide the width.
LEVELS = (1, 4, 16, 32)
#: Bytes of a shard's vectors at most, beside one block.
SHARD_BYTES = 1 << 26
#: Pairs of a query with the highest bounds in a block, computed first, a time its k.
FIRST = 2
#: Pairs gathered together.
PAIRS = 1 << 15
#: Products up to these stay exact in single and in double precision.
EXACT_SINGLE, EXACT = 2.0**24, 2.0**53
#: Rounding of a bound, as a share of the norms' product.
SLACK = 2e-5


def integer_vector(vector: list | None) -> np.ndarray | None:
    """floor(64 x) of each component, or None for null vectors or components that aren't finite."""
    if vector is None or any(x is None for x in vector):
        return None
    values = np.floor(SCALE * np.array(vector, dtype=np.float64))
    return values if np.isfinite(values).all() else None


def segment_features(values: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(L) times mean and deviation of each segment, side by side."""
    cut = values.reshape(len(values), segments, -1)
    return np.hstack((cut.mean(axis=2), cut.std(axis=2))) * math.sqrt(cut.shape[2])


class Block:
    """Candidates of one width with their statistics."""

    def __init__(self, ids: np.ndarray, values: np.ndarray) -> None:
        self.ids, self.values = ids, values
        width = values.shape[1]
        self.levels = [n for n in LEVELS if width and width % n == 0 and n < width]
        # Single precision, as SLACK allows for; scaled so that no square overflows.
        self.scale = max(1.0, float(np.abs(values).max(initial=0)))
        self.features = [(segment_features(values, n) / self.scale).astype(np.float32) for n in self.levels]
        self.norms = np.sqrt(((values / self.scale) ** 2).sum(axis=1))


class Search:
    """Running best k of a block of queries."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, top: int) -> None:
        self.ids, self.top, self._queries = ids, top, Block(ids, queries)
        self.best_score = np.full((len(ids), top), -np.inf, dtype=object if self._wide(self._queries) else np.float64)
        self.best_id = np.full((len(ids), top), np.iinfo(np.int64).max)
        #: Pairs met, and those of them that were computed.
        self.met = self.computed = 0

    def _reach(self, block: Block) -> float:
        """No sum of products is larger."""
        return self._queries.scale * block.scale * block.values.shape[1]

    def _wide(self, block: Block) -> bool:
        return self._reach(block) >= EXACT

    def add(self, block: Block) -> None:
        """Scores a block of candidates, leaving out pairs that the bounds rule out."""
        queries = self._queries
        own = self.ids[:, None] == block.ids[None, :]
        self.met += own.size - int(own.sum())
        alive, bound = ~own, None
        scale = queries.scale * block.scale
        slack = SLACK * queries.norms[:, None] * block.norms.max(initial=0) * scale
        for mine, theirs in zip(queries.features, block.features):
            bound = (mine @ theirs.T).astype(np.float64) * scale + slack
            alive &= bound >= self.best_score[:, -1:].astype(np.float64)
            if not alive.any():
                return
        if bound is not None and len(block.ids) > FIRST * self.top:
            hopes = np.where(alive, bound, -np.inf)
            first = np.argpartition(-hopes, FIRST * self.top, axis=1)[:, : FIRST * self.top]
            picked = np.zeros_like(alive)
            np.put_along_axis(picked, first, True, axis=1)
            picked &= alive
            self._score(block, picked)
            alive &= ~picked
            alive &= bound >= self.best_score[:, -1:].astype(np.float64)
        self._score(block, alive)

    def _score(self, block: Block, chosen: np.ndarray) -> None:
        rows, columns = np.nonzero(chosen)
        self.computed += len(rows)
        if not len(rows):
            return
        reach = self._reach(block)
        kind = np.float32 if reach < EXACT_SINGLE else np.float64
        q, v = self._queries.values.astype(kind), block.values.astype(kind)
        if reach >= EXACT:
            scores = np.array([sum(int(a) * int(b) for a, b in zip(q[i], v[j])) for i, j in zip(rows, columns)], dtype=object)
            self.best_score = self.best_score.astype(object)
        else:
            scores = np.concatenate([
                np.einsum("ij,ij->i", q[rows[at : at + PAIRS]], v[columns[at : at + PAIRS]]) for at in range(0, len(rows), PAIRS)
            ]).astype(np.float64)
        # Pairs come by query; only those that reach its k-th best are sorted in.
        hopeful = scores >= self.best_score[rows, -1]
        rows, columns, scores = rows[hopeful], columns[hopeful], scores[hopeful]
        starts = np.searchsorted(rows, np.arange(len(self.ids) + 1))
        for row in np.unique(rows):
            part = slice(starts[row], starts[row + 1])
            score = np.concatenate((self.best_score[row], scores[part]))
            key = np.concatenate((self.best_id[row], block.ids[columns[part]]))
            order = np.lexsort((key, -score))[: self.top]
            self.best_score[row], self.best_id[row] = score[order], key[order]

    def result(self) -> pd.DataFrame:
        real = (self.best_score > -np.inf).astype(bool)
        return pd.DataFrame({
            "query_id": np.repeat(self.ids, real.sum(axis=1)),
            "vec_id": self.best_id[real],
            "score": np.array([int(x) for x in self.best_score[real]], dtype=np.int64),
        })


def shard_count(rows: int, size: int, cores: int) -> int:
    """Shards of candidates: as their size wants, and no fewer than the cores while each has a block.

    Every candidate is in one shard, every query in all of them.
    """
    return max(1, -(-size // SHARD_BYTES), min(cores, -(-rows // CANDIDATE_BLOCK)))


def _packed(vectors: DataFrame, blocks: int) -> DataFrame:
    """Blocks of vectors of one width, dealt by hash: n, width, ids and values as bytes."""
    dealt = vectors.withColumn("n", F.expr(f"pmod(xxhash64(vec_id, value), {blocks})").cast("int"))
    gathered = dealt.groupBy("n", "width").agg(F.collect_list(F.struct("vec_id", "value")).alias("rows"))

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for n, width, found in zip(frame["n"], frame["width"], frame["rows"], strict=True):
                ids = np.array([r["vec_id"] for r in found], dtype=np.int64)
                yield pd.DataFrame([{"n": n, "width": width, "ids": ids.tobytes(), "packed": b"".join(r["value"] for r in found)}])

    return gathered.mapInPandas(pack, "n int, width int, ids binary, packed binary")


def top_products(
    vectors: DataFrame,
    is_query: str,
    top: int = TOP,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its best other rows.

    is_query is SQL over vec_id, the id column, that names the queries; all rows are candidates but those
    with the query's own id. Components are floor(64 x); the score is their integer inner
    product; ties go to the smaller id. A query with fewer candidates has them all.
    Vectors that are null, or hold null or non-finite components, and rows without an id
    take no part, nor do vectors of other lengths than the query's. Rows that repeat an
    id with an equal vector count once. Scores beyond a long aren't defined. Only the two
    columns are read, whatever others are called; an empty table gives no rows.
    """

    def make():
        def work(ids: list, rows: list) -> list[list]:
            found = [(key, v) for key, row in zip(ids, rows, strict=True) if key is not None and (v := integer_vector(row)) is not None]
            return [[k for k, _ in found], [len(v) for _, v in found], [(v + 0.0).tobytes() for _, v in found]]

        return work

    typed = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vector"))
    values = map_columns(typed, ["vec_id", "vector"], "vec_id long, width int, value binary", make)
    values = durable(values.distinct())
    asked = values.where(is_query)
    sizes = values.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("size")).first()
    shards = shard_count(sizes["rows"], sizes["size"], values.sparkSession.sparkContext.defaultParallelism)
    # Blocks are dealt to shards in turn, so there are as many of them in each.
    blocks = shards * max(1, -(-sizes["rows"] // (shards * CANDIDATE_BLOCK)))
    candidates = _packed(values, blocks).withColumn("kind", F.lit(0)).withColumn("shard", F.col("n") % shards)
    queries = durable(_packed(asked, max(1, -(-asked.count() // QUERY_BLOCK)))).withColumn("kind", F.lit(1))
    # The stated queries against all rows.
    queries = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    order = ["shard", "width", "kind", "n"]
    met = candidates.unionByName(queries).repartition(shards, "shard").sortWithinPartitions(*order)

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, []
        for frame in frames:
            for row in frame.itertuples():
                if at != (row.shard, row.width):
                    at, held = (row.shard, row.width), []
                ids = np.frombuffer(row.ids, np.int64)
                values = np.frombuffer(row.packed).reshape(len(ids), -1)
                if row.kind == 0:
                    held.append(Block(ids, values))
                elif held:
                    now = Search(ids, values, top)
                    for block in held:
                        now.add(block)
                    yield now.result()

    found = met.mapInPandas(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # A query has at most `top` rows from each shard here.
    ranked = found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
