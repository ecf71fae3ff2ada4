"""What several operators share: durable tables, mapping over texts, ranks and components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLICE_ROWS = 256


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir.

    Where none is set, a session on one machine takes a temporary one; any other is refused.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder as a checkpoint and read from there, lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder as a table, packed by columns, and read from there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_columns(
    df: DataFrame,
    read: list[str],
    schema: str,
    make: Callable[[], Callable[..., list[list]]],
) -> DataFrame:
    """Rows that a function makes from slices of a few hundred rows.

    make() runs once a task and gives the function; that takes the columns in `read`
    as lists and gives the columns of `schema` as lists, of any one length.
    """
    spark = df.sparkSession
    names = spark.createDataFrame([], schema).columns
    wanted = [F.col(f"`{name}`") for name in read]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                made = work(*(column.to_pylist() for column in part.columns))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(made, kinds, strict=True)], names
                )

    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = list(to_arrow_schema(spark.createDataFrame([], schema).schema).types)
    return df.select(*wanted).mapInArrow(run, schema)


def salted_rank(df: DataFrame, keys: list[str], order: list[str], salt: Column, name: str) -> DataFrame:
    """Adds a rank from 0, without gaps, within each key; no key is ever in one task.

    A key's rows are split by `salt`, which must depend on the row alone. Each part is
    numbered by itself and starts where the parts before it end. The input is read
    twice, so it should be durable.
    """
    salted = df.withColumn("_salt", salt)
    parts = [*keys, "_salt"]
    sizes = salted.groupBy(*parts).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*parts, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    numbered = salted.withColumn("_place", F.row_number().over(Window.partitionBy(*parts).orderBy(*order)))
    return (
        numbered.join(starts, parts)
        .withColumn(name, F.col("_start") + F.col("_place") - 1)
        .drop("_salt", "_start", "_place")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; root is the smallest node reachable.

    edges: columns a and b, long, not null. Alternates large-star and small-star steps,
    each an aggregation for the smallest neighbour and a join with it, until every link
    leads to its root. The rounds grow with the logarithm of the largest component.
    """
    links = durable(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(nearest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(smallest, "u")
        small = joined.select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        now = durable(small.select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct())
        roots = now.select(F.col("v").alias("root")).distinct()
        if now.join(roots, F.col("u") == F.col("root"), "left_semi").isEmpty() and _one_root(now):
            itself = roots.select(F.col("root").alias("node"), "root")
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(itself)
        links = now


def _one_root(links: DataFrame) -> bool:
    return links.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
