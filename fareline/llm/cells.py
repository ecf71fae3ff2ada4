"""Range joins by cells: a grid of blocks for each cell, and links found inside a block."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grid(
    reached: DataFrame, cell: list[str], hashed: Column, own_block: int, visitor_block: int, few_cells: bool = False
) -> DataFrame:
    """Copies each cell's rows to the blocks of a grid: own rows by all visitors.

    reached: a row for each point and cell that it visits, `own` true in its own cell,
    durable. In the result, `own` marks the own side; a and b are the block. A cell with
    very many rows is so divided among tasks, none of which holds more than about a block
    of either side; a small cell is one block. few_cells: the number of cells is bounded,
    so that their sizes may be broadcast.
    """
    sizes = reached.groupBy(*cell).agg(
        F.greatest(F.lit(1), F.ceil(F.sum(F.col("own").cast("long")) / own_block)).cast("int").alias("na"),
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / visitor_block)).cast("int").alias("nb"),
    )
    sized = reached.join(F.broadcast(sizes) if few_cells else sizes, cell).withColumn("h", hashed)
    kept = [c for c in reached.columns if c != "own"]
    visitors = sized.select(
        *kept,
        F.lit(False).alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("na") - 1)).alias("a"),
        F.expr("pmod(h, nb)").cast("int").alias("b"),
    )
    own = sized.where("own").select(
        *kept,
        F.lit(True).alias("own"),
        F.expr("pmod(h, na)").cast("int").alias("a"),
        F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("b"),
    )
    return visitors.unionByName(own)


class LocalLinks:
    """Joins linked nodes of two lists as pairs arrive, and keeps a tree instead of the pairs."""

    def __init__(self, own: np.ndarray, visitors: np.ndarray) -> None:
        self._nodes = np.unique(np.concatenate((own, visitors)))
        self._own = np.searchsorted(self._nodes, own)
        self._visitors = np.searchsorted(self._nodes, visitors)
        self._label = np.arange(len(self._nodes))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        """Links own nodes i with visitors j. Each round hangs every label below the least
        that it is linked with, which leaves at most half of the labels that have links."""
        x, y = self._own[i], self._visitors[j]
        while True:
            a, b = self._label[x], self._label[y]
            differ = a != b
            if not differ.any():
                return
            x, y, a, b = x[differ], y[differ], a[differ], b[differ]
            up = np.arange(len(self._nodes))
            np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
            while (up[up] != up).any():
                up = up[up]
            self._label = up[self._label]

    def edges(self) -> pd.DataFrame:
        """(a, b): each node that isn't the least of its group, and that least one."""
        hung = np.flatnonzero(self._label != np.arange(len(self._label)))
        return pd.DataFrame({"a": self._nodes[hung].astype(np.int64), "b": self._nodes[self._label[hung]].astype(np.int64)})
