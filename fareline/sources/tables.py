"""Tables on files: namespaces, full rebuilds, streaming tables and a table merged on a key."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.functions.calendar import year_month
from fareline.operators.upsert import changed_rows, keep_newest, merge_rows
from fareline.sources.json_files import MAX_FILE_AGE
from fareline.sources.storage import make_folder, or_none, remove

LAYERS = ("bronze", "silver", "gold")
MONTH = "_month"


def create_namespaces(spark: SparkSession, location: str | None = None) -> None:
    for layer in LAYERS:
        place = f" LOCATION '{location.rstrip('/')}/{layer}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}{place}")


def rebuild(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a table's content: the sink of materialized views and rebuilt tables."""
    df.write.mode("overwrite").format(fmt).save(path)


def rebuild_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").format(fmt).saveAsTable(name)


@dataclass(frozen=True)
class StreamTable:
    """An append-only table fed by one or more flows.

    Each flow has its own folder and its own checkpoint, so one can be reset or
    re-run without the others. Readers see their union, downstream streams follow
    one flow each.
    """

    root: str
    ddl: str
    flows: tuple[str, ...] = ("main",)

    def data(self, flow: str = "main") -> str:
        return f"{self.root.rstrip('/')}/data/flow={self._known(flow)}"

    def checkpoint(self, flow: str = "main") -> str:
        return f"{self.root.rstrip('/')}/checkpoints/{self._known(flow)}"

    def _known(self, flow: str) -> str:
        if flow not in self.flows:
            raise ValueError(f"{flow} is not a flow of {self.root}; it has {self.flows}")
        return flow

    def read(self, spark: SparkSession) -> DataFrame:
        """Everything committed so far, over all flows that have started."""
        reader = spark.read.schema(self.ddl).option("recursiveFileLookup", "true")
        loaded = [or_none(lambda f=flow: reader.parquet(self.data(f))) for flow in self.flows]
        started = [df for df in loaded if df is not None]
        if not started:
            raise ValueError(f"no flow has written to {self.root} yet")
        return reduce(DataFrame.unionByName, started)

    def stream(self, spark: SparkSession, flow: str = "main", max_files: int | None = None) -> DataFrame:
        """A flow's rows as they are committed; the flow need not have started."""
        make_folder(spark, self.data(flow))
        reader = spark.readStream.schema(self.ddl).option("maxFileAge", MAX_FILE_AGE)
        reader = reader.option("recursiveFileLookup", "true")
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(self.data(flow))

    def register(self, spark: SparkSession, name: str) -> None:
        """Make the table known to the catalog, over all its flows and whatever they add later.

        ``spark.read.table`` and ``spark.readStream.table`` then take it by its name.
        """
        for flow in self.flows:
            make_folder(spark, self.data(flow))
        spark.catalog.createTable(
            name, f"{self.root.rstrip('/')}/data", "parquet", spark.createDataFrame([], self.ddl).schema, recursiveFileLookup="true"
        )

    def reset(self, spark: SparkSession, flow: str = "main") -> None:
        """Drop one flow's rows and its checkpoint, so that its next start replays its source.

        Other flows stay. Flows that read from this one must be reset first, or they take
        the replayed rows for new ones. Cut short, it can be repeated.
        """
        if any(query.name == self.query_name(flow) for query in spark.streams.active):
            raise ValueError(f"stop flow {flow} of {self.root} before resetting it")
        remove(spark, self.checkpoint(flow))
        remove(spark, self.data(flow))

    def query_name(self, flow: str = "main") -> str:
        """The name under which a flow's query runs and reports."""
        return f"{self.root.rstrip('/')}#{self._known(flow)}"


@dataclass(frozen=True)
class KeyedTable:
    """A parquet table merged on a key, partitioned by month.

    A merge rewrites the months that hold a key of the batch, by dynamic partition
    overwrite, and leaves all others as they are. One writer at a time is assumed; a merge
    that dies is repeated with the same batch. Batch rows that equal the table's in all but
    the ``unset`` columns change nothing. Past versions and concurrent writers are the
    matter of formats with row-level changes, which take ``upsert.merge_into``.
    """

    root: str
    key: str
    day: str
    newest: tuple[str, ...]
    unset: tuple[str, ...] = ()

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _stored(self, spark: SparkSession) -> DataFrame | None:
        """The rows with their month; columns that later merges brought read as null in older files."""
        return or_none(lambda: spark.read.option("mergeSchema", "true").parquet(self._path("data")))

    def is_empty(self, spark: SparkSession) -> bool:
        """Whether nothing has been merged yet."""
        return self._stored(spark) is None

    def read(self, spark: SparkSession) -> DataFrame:
        stored = self._stored(spark)
        if stored is None:
            raise ValueError(f"nothing has been merged into {self.root} yet")
        return stored.drop(MONTH)

    def merge(self, batch: DataFrame) -> int:
        """Merge the newest batch row of each key; returns how many rows that added or changed."""
        spark = batch.sparkSession
        # Equal stamps are settled by all other columns, so a retry keeps the same row.
        others = F.struct(*[c for c in batch.columns if c not in (*self.newest, *self.unset)])
        order = [*[F.col(c).desc_nulls_last() for c in self.newest], others.desc()]
        stored = self._stored(spark)
        if stored is None:
            # Without rows no table begins.
            if batch.isEmpty():
                return 0
            self._first_load(batch, order)
            return self.read(spark).count()
        # The batch is used several times below: compute it once, in shared storage.
        staged = self._staged(keep_newest(batch, self.key, order), "arrived")
        holding = stored.select(self.key, MONTH).join(staged.select(self.key), self.key, "left_semi").select(MONTH)
        months = [row[0] for row in holding.union(staged.select(self._month())).distinct().collect()]
        touched = stored.where(F.col(MONTH).isin(months))
        # A key in two months is what a merge that died has left; its row counts as changed.
        held = touched.join(staged.select(self.key), self.key, "left_semi").groupBy(self.key).count()
        single = touched.join(held.where("count > 1"), self.key, "left_anti")
        staged = self._staged(changed_rows(single.drop(MONTH), staged, self.key, self.unset), "changed")
        # Of those months only the ones that hold or take a row that changes.
        holding = touched.join(staged.select(self.key), self.key, "left_semi").select(MONTH)
        losing = {row[0] for row in holding.distinct().collect()}
        gaining = {row[0] for row in staged.select(self._month()).distinct().collect()}
        touched = stored.where(F.col(MONTH).isin([*losing | gaining]))
        rows = merge_rows(touched.drop(MONTH), staged, self.key)
        kept = touched.select(self.key, MONTH).join(staged.select(self.key), self.key, "left_anti")
        left = {row[0] for row in kept.select(MONTH).distinct().collect()}
        emptied = sorted(losing - gaining - left)
        count = staged.count()
        if count:
            self._lay_out(rows)
            # A month all of whose rows have moved away is written by none of them.
            for month in emptied:
                remove(spark, f"{self._path('data')}/{MONTH}={month}")
        return count

    def _first_load(self, batch: DataFrame, order: list[Column]) -> None:
        """Lay out a batch that needn't be staged, as nothing is compared with it.

        Only the rows of repeated keys are shuffled to find the newest, all others go straight
        to their months. The repeated keys are stored meanwhile, as their size decides the joins.
        """
        spark, path = batch.sparkSession, self._path("repeated")
        counted = batch.groupBy(F.col(self.key).alias("_repeated")).agg(F.count(F.lit(1)).alias("_rows"))
        rebuild(counted.where("_rows > 1").select("_repeated"), path)
        try:
            repeated = spark.read.schema(batch.select(F.col(self.key).alias("_repeated")).schema).parquet(path)
            if not repeated.isEmpty():
                same = batch[self.key].eqNullSafe(F.col("_repeated"))
                several = keep_newest(batch.join(repeated, same, "left_semi"), self.key, order)
                batch = batch.join(repeated, same, "left_anti").unionByName(several)
            self._lay_out(batch)
        finally:
            remove(spark, path)

    def _lay_out(self, rows: DataFrame) -> None:
        """Replace the months of the rows. Rebalancing gives a big month many files and a small one few."""
        laid_out = rows.withColumn(MONTH, self._month()).hint("rebalance", MONTH)
        writer = laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(MONTH).parquet(self._path("data"))

    def _month(self) -> Column:
        """The layout column: year and month of the day, 0 for rows without one."""
        return F.coalesce(year_month(F.col(self.day)), F.lit(0)).alias(MONTH)

    def _staged(self, rows: DataFrame, name: str) -> DataFrame:
        path = self._path(f"batch/{name}")
        rows.write.mode("overwrite").parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)
