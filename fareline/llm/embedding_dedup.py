"""Near-duplicate vectors by an exact metric range join.

Unit vectors with cosine of at least c are at a distance of at most r = sqrt(2 - 2c). A
bounded number of pivots divides each label's vectors into cells of nearest pivots. A
vector also visits another pivot's cell if a partner within r may be in it: the triangle
inequality and the plane between two pivots bound how near the vector must come. So each
cell's own vectors against its visitors give every link, and cells are independent.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.cells import LocalLinks, grid
from fareline.llm.common import components, durable, map_columns

THRESHOLD = 0.93
#: Distinct vectors a pivot, pivots a label, and pivots in all, which bounds the sample.
VECTORS_A_PIVOT, MOST_PIVOTS, ALL_PIVOTS = 1000, 64, 4096
OWN_BLOCK, VISITOR_BLOCK = 4096, 16_384
ROUNDING = 1e-6


def unit_vector(vector: list | None) -> np.ndarray | None:
    """The vector in double precision at length 1, or None if it has no direction."""
    if not vector or any(x is None for x in vector):
        return None
    values = np.array(vector, dtype=np.float64)
    largest = np.abs(values).max()
    if not np.isfinite(largest) or largest == 0:
        return None
    values /= largest
    return values / math.sqrt(float(values @ values))


def unit_vectors(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, unit, digest); unit and digest are null where nothing can link."""
    kinds = dict(vectors.dtypes)

    def make():
        def work(ids: list, rows: list, labels: list) -> list[list]:
            units = [
                unit_vector(row) if label is not None and key is not None else None
                for key, row, label in zip(ids, rows, labels, strict=True)
            ]
            packed = [None if u is None else (u + 0.0).tobytes() for u in units]
            digests = [None if p is None else hashlib.blake2b(p, digest_size=16).digest() for p in packed]
            return [ids, labels, packed, digests]

        return work

    schema = f"vec_id {kinds[id_col]}, label {kinds[label_col]}, unit binary, digest binary"
    return map_columns(vectors, [id_col, vec_col, label_col], schema, make)


def choose_pivots(points: DataFrame) -> dict[tuple, np.ndarray]:
    """Pivots by (label, bytes of a vector): distinct vectors with the smallest digests.

    Their number follows a label's distinct vectors up to MOST_PIVOTS, and is cut for all
    labels alike where they would be more than ALL_PIVOTS; labels without a pivot are one
    cell. Pivots shape the cells and nothing else.
    """
    sizes = points.groupBy("label", F.length("unit").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    wanted = sizes.withColumn("k", F.least(F.floor(F.col("n") / VECTORS_A_PIVOT), F.lit(MOST_PIVOTS))).where("k > 1")
    wanted = wanted.orderBy(F.desc("n"), "label", "width").limit(ALL_PIVOTS // 2)
    share = F.col("k") / F.col("n") * 2
    spread = (F.xxhash64("digest") / F.lit(2.0**64)) + 0.5
    some = points.withColumn("width", F.length("unit")).join(wanted, ["label", "width"]).where(spread < share)
    pivots = defaultdict(list)
    for row in some.orderBy("digest").limit(2 * ALL_PIVOTS).collect():
        cell = pivots[row.label, row.width]
        if len(cell) < row.k:
            cell.append(np.frombuffer(row.unit))
    return {key: np.array(cell) for key, cell in pivots.items()}


def visits(units: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the vector, cell, and whether the cell is its own.

    A partner y of x in the cell of q, where x's own pivot is p, satisfies
    d(x, q) <= d(x, p) + 2r (triangle inequality) and lies beyond the plane between p and
    q, so x is at most r before it: d(x, q)^2 - d(x, p)^2 <= 2 r d(p, q).
    """
    squares = np.maximum(2 - 2 * (units @ pivots.T), 0)
    own = squares.argmin(axis=1)
    least = squares[np.arange(len(units)), own][:, None]
    apart = np.sqrt(np.maximum(2 - 2 * (pivots @ pivots.T), 0))[own]
    near = np.sqrt(squares) <= np.sqrt(least) + 2 * radius + ROUNDING
    near &= squares - least <= 2 * radius * apart + ROUNDING
    near[np.arange(len(units)), own] = True
    at, cell = np.nonzero(near)
    return at, cell, cell == own[at]


def link_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row.

    Vectors are linked if their labels are equal and not null and their cosine, in double
    precision, is at least the threshold. n_links counts the other rows linked directly,
    copies of the vector included. Vectors that are null, zero, or hold null or
    non-finite components, and rows without a label or an id, link with nothing: n_links
    0 and a component of their own. Vectors of different lengths don't link. Rows with
    the same id are one node of the graph. Equal vectors are compared once and counted
    with their number. Ids are integers, results long.
    """
    rows = durable(unit_vectors(vectors, id_col, vec_col, label_col))
    points = durable(
        rows.where("unit is not null")
        .groupBy("label", "digest")
        .agg(F.first("unit").alias("unit"), F.min("vec_id").cast("long").alias("node"), F.count(F.lit(1)).alias("copies"))
    )
    spark = vectors.sparkSession
    pivots = spark.sparkContext.broadcast(choose_pivots(points))
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["width"] = frame["unit"].map(len)
            for key, group in frame.groupby(["label", "width"], sort=False):
                centres = pivots.value.get(key)
                if centres is None:
                    yield group.assign(cell=0, own=True)
                    continue
                units = np.frombuffer(b"".join(group["unit"]), np.float64).reshape(len(group), -1)
                at, cell, own = visits(units, centres, radius)
                yield group.iloc[at].assign(cell=cell, own=own)

    label = dict(points.dtypes)["label"]
    shape = f"label {label}, digest binary, unit binary, node long, copies long, width int, cell int, own boolean"
    reached = durable(points.mapInPandas(deal, shape))
    cells = grid(reached, ["label", "width", "cell"], F.xxhash64("digest"), OWN_BLOCK, VISITOR_BLOCK)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        own, others = group[group["own"]], group[~group["own"]]
        links = LocalLinks(own["node"].to_numpy(), others["node"].to_numpy())
        x = np.frombuffer(b"".join(own["unit"]), np.float64).reshape(len(own), -1)
        counts = np.zeros(len(own), np.int64)
        for begin in range(0, len(others), 4096):
            part = others.iloc[begin : begin + 4096]
            y = np.frombuffer(b"".join(part["unit"]), np.float64).reshape(len(part), -1)
            copies = part["copies"].to_numpy()
            for start in range(0, len(x), 1024):
                near = x[start : start + 1024] @ y.T >= threshold
                counts[start : start + 1024] += near @ copies
                i, j = np.nonzero(near)
                links.add(i + start, j + begin)
        found = links.edges().assign(label=None, digest=None, links=0)
        own = own[["label", "digest"]].assign(a=-1, b=-1, links=counts)
        return pd.concat([own, found], ignore_index=True) if len(found) else own

    schema = f"label {label}, digest binary, a long, b long, links long"
    found = durable(cells.groupBy("label", "width", "cell", "a", "b").applyInPandas(compare, schema))
    counts = found.where("digest is not null").groupBy("label", "digest").agg(F.sum("links").alias("links"))
    roots = components(found.where("digest is null").select("a", "b"))
    known = points.join(counts, ["label", "digest"]).join(roots, "node", "left")
    known = known.select(
        "label", "digest", (F.col("links") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id")
    )
    alone = rows.where("unit is null").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").cast("long").alias("component_id"),
    )
    linked = rows.where("unit is not null").join(known, ["label", "digest"])
    linked = linked.select(F.col("vec_id").cast("long").alias("vec_id"), "n_links", "component_id")
    return linked.unionByName(alone).select(
        F.col("vec_id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
