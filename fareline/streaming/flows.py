"""The hops of the ride pipeline as streaming queries.

bronze (events, files) -> staging (two flows) -> enriched. Every hop can run
continuously or, by default, catch up with its input and stop.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fareline import schemas as S
from fareline.operators.expectations import enforce
from fareline.operators.upsert import look_back_bound
from fareline.plans.enrich import enriched, rides_enriched
from fareline.plans.staging import bulk_rides, live_rides, staged
from fareline.plans.star import DIMENSIONS, dim_date, dimensions, fct_rides, stage_rides
from fareline.session import STATE_STORE, no_shuffles_left
from fareline.sources.json_files import bronze_files, evolve, infer_schema, lineage, stream_lines
from fareline.sources.kafka import bronze_rides
from fareline.sources.storage import exists, make_folder, or_none, remove
from fareline.sources.tables import KeyedTable, StreamTable, rebuild

CATCH_UP: Mapping[str, object] = {"availableNow": True}
LINE_DDL = (
    "value string, _metadata struct<file_path: string, file_modification_time: timestamp>"
)
PROCESSED = "_silver_processed_at"
LIVE, BULK = "flow_stream_rides", "flow_bulk_rides"


def bronze_rides_table(root: str) -> StreamTable:
    return StreamTable(f"{root}/bronze/rides_raw", S.BRONZE_RIDE_DDL)


def staging_table(root: str) -> StreamTable:
    return StreamTable(f"{root}/silver/staging_rides", S.SILVER_RIDE_DDL, (LIVE, BULK))


def enriched_table(spark: SparkSession, root: str) -> StreamTable:
    """The flows of staging carry on, so either source can be replayed on its own."""
    refs = {name: spark.createDataFrame([], ref.ddl) for name, ref in S.REFERENCES.items()}
    schema = enriched(spark.createDataFrame([], S.SILVER_RIDE_DDL), refs).schema
    return StreamTable(f"{root}/silver/rides_enriched", ddl_of(schema), (LIVE, BULK))


def ddl_of(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def append(
    df: DataFrame,
    table: StreamTable,
    flow: str = "main",
    trigger: Mapping[str, object] = CATCH_UP,
    write: Callable[[DataFrame, str, int], None] | None = None,
) -> StreamingQuery:
    """Start a flow: append the stream's rows to its part of the table, each exactly once.

    A micro-batch has its own folder, named by the checkpoint it belongs to; a batch that
    is run again after it was written is passed over, and one that was cut short replaces
    what it left. Rows are rebalanced, so a batch of many small tasks gives few files
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes`` is their size). What a batch has
    shuffled goes with it. ``write`` replaces how a batch's rows are put into its folder.
    """
    spark = df.sparkSession
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    make_folder(spark, table.data(flow))

    def write_batch(batch: DataFrame, number: int) -> None:
        checkpoint = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        path = f"{table.data(flow)}/run={checkpoint}/batch={number}"
        if not exists(batch.sparkSession, f"{path}/_SUCCESS"):
            (write or write_rows)(batch, path, number)

    # A flow runs in a copy of the session as it is at the start.
    with no_shuffles_left(spark):
        return (
            df.writeStream.foreachBatch(write_batch)
            .queryName(table.query_name(flow))
            .outputMode("append")
            .option("checkpointLocation", table.checkpoint(flow))
            .trigger(**trigger)
            .start()
        )


def write_rows(rows: DataFrame, path: str, number: int = 0) -> None:
    """A micro-batch's rows in files of the advised size."""
    rows.hint("rebalance").write.mode("overwrite").parquet(path)


def start_bronze_rides(records: DataFrame, root: str, **options) -> StreamingQuery:
    """Kafka records to bronze. A record without payload stops the query."""
    return append(enforce(bronze_rides(records), S.RAW_RULES), bronze_rides_table(root), **options)


def start_live_staging(
    spark: SparkSession,
    root: str,
    max_files: int | None = None,
    combine: bool = False,
    state_partitions: int | None = None,
    **options,
) -> StreamingQuery:
    """Bronze events to staging: parse, drop repeats within the horizon, apply constraints.

    Each batch's progress reports the constraint counts under LIVE, and under LIVE_arrived
    the rows before the dedup and those of them without an id, which never reach it. Rows
    behind the watermark are in its state metrics as numRowsDroppedByWatermark.

    ``state_partitions`` fixes over how many tasks the dedup state spreads. It counts at
    the flow's first start only; by default the session's shuffle partitions apply.
    """
    bronze = bronze_rides_table(root).stream(spark, max_files=max_files)
    rides = staged(live_rides(bronze, combine, arrived=f"{LIVE}_arrived"), LIVE)
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions or usual))
    try:
        return append(rides, staging_table(root), LIVE, **options)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)


def start_bulk_staging(
    bronze: FileTable, spark: SparkSession, root: str, max_files: int | None = None, **options
) -> StreamingQuery:
    """Bronze bulk rides to staging."""
    rides = bulk_rides(bronze.stream(spark, max_files))
    return append(staged(rides, BULK), staging_table(root), BULK, **options)


def start_enrich(
    spark: SparkSession,
    root: str,
    flow: str,
    refs: Callable[[], Mapping[str, DataFrame]],
    max_files: int | None = None,
    trigger: Mapping[str, object] = CATCH_UP,
    processed_at: Column | None = None,
    report: Callable[[int, dict], None] | None = None,
) -> StreamingQuery:
    """Staging to enriched: stream-static left joins against the reference tables.

    ``refs`` is called for every micro-batch, so a corrected reference row applies from
    the next batch on without a restart; no join state is kept. ``report`` gets each
    batch's constraint counts.
    """
    table = enriched_table(spark, root)

    def write(batch: DataFrame, path: str, number: int) -> None:
        counts = Observation() if report else None
        write_rows(rides_enriched(batch, refs(), processed_at, counts), path)
        if report:
            report(number, counts.get)

    return append(staging_table(root).stream(spark, flow, max_files), table, flow, trigger, write)


def reset_flow(spark: SparkSession, root: str, flow: str) -> None:
    """Drop a flow's rides from staging and all that follows it, and have it replayed.

    The other flow, bronze and gold stay; the flow's next starts read bronze from its
    beginning, and the next load of gold merges its rides again by their ids.
    """
    enriched_table(spark, root).reset(spark, flow)
    staging_table(root).reset(spark, flow)


def load_fact(
    spark: SparkSession, root: str, refs: Callable[[], Mapping[str, DataFrame]], target: KeyedTable
) -> int:
    """Merge enriched rides into the fact: all of them first, afterwards the new ones and
    those of the look-back. Returns how many rows that added or changed; run again without
    new rides, none."""
    rides = enriched_table(spark, root).read(spark)
    if not target.is_empty(spark):
        rides = rides.where(F.col(PROCESSED) > look_back_bound(target.read(spark), PROCESSED))
    return target.merge(fct_rides(stage_rides(rides), dimensions(refs())))


def dimension_path(root: str, name: str) -> str:
    return f"{root}/gold/{name}"


def build_gold(
    spark: SparkSession,
    root: str,
    refs: Callable[[], Mapping[str, DataFrame]],
    today: Column | None = None,
) -> int:
    """Rebuild the stored dimensions and the calendar, then merge the fact. Returns its changed rows."""
    for name, rows in {**dimensions(refs()), "dim_date": dim_date(spark, today)}.items():
        rebuild(rows, dimension_path(root, name))
    return load_fact(spark, root, refs, fact_table(root))


def gold_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The stored gold tables by name, as tests and reports read them."""
    names = [*DIMENSIONS, "dim_date"]
    stored = {name: spark.read.parquet(dimension_path(root, name)) for name in names}
    return {**stored, "fct_rides": fact_table(root).read(spark)}


def fact_table(root: str) -> KeyedTable:
    return KeyedTable(f"{root}/gold/fct_rides", "ride_id", "date_key", (PROCESSED,), unset=("_gold_built_at",))


@dataclass(frozen=True)
class FileTable:
    """A bronze table over a JSON folder whose columns grow with the files.

    Every micro-batch looks at the fields of its own lines before they are parsed: a field
    that the table lacks becomes a column from that batch on, while the query runs, and
    rows stored before read as null there. The files are scanned once; their lines are
    held for the time of the batch, compressed, beside the table. The columns known so far
    are logged beside the checkpoint before the first rows that have them.
    """

    root: str
    folder: str

    @property
    def _log(self) -> str:
        return f"{self.root.rstrip('/')}/schemas"

    def _latest(self, spark: SparkSession) -> T.StructType | None:
        ddl = "seen_micros bigint, schema string"
        log = or_none(lambda: spark.read.schema(ddl).json(self._log))
        row = log and log.orderBy(F.desc("seen_micros")).first()
        return T.StructType.fromJson(json.loads(row.schema)) if row else None

    def schema(self, spark: SparkSession) -> T.StructType:
        """Columns known so far, lineage included."""
        known = self._latest(spark)
        if known is None:
            raise ValueError(f"no file of {self.folder} has been read yet")
        lines = spark.createDataFrame([], LINE_DDL)
        return bronze_files(lines, known).schema

    def _grown(self, lines: DataFrame) -> T.StructType:
        """The known columns and those that the lines bring; new ones are logged."""
        spark = lines.sparkSession
        known = self._latest(spark)
        grown = evolve(known, infer_schema(lines))
        if grown != known:
            now = int(datetime.now(timezone.utc).timestamp() * 1e6)
            entry = spark.createDataFrame([(now, grown.json())], "seen_micros bigint, schema string")
            entry.coalesce(1).write.mode("append").json(self._log)
        return grown

    def _table(self, spark: SparkSession) -> StreamTable:
        return StreamTable(self.root, ddl_of(self.schema(spark)))

    def start(
        self, spark: SparkSession, max_files: int | None = None, **options
    ) -> StreamingQuery:
        """Append new files to the table, their new fields as new columns."""

        def write(batch: DataFrame, path: str, number: int) -> None:
            spark, held = batch.sparkSession, f"{self.root.rstrip('/')}/held/batch={number}"
            try:
                batch.write.mode("overwrite").parquet(held)
                lines = spark.read.schema(batch.schema).parquet(held)
                write_rows(bronze_files(lines, self._grown(lines)), path)
            finally:
                remove(spark, held)

        lines = stream_lines(spark, self.folder, max_files).select("value", *lineage())
        return append(lines, StreamTable(self.root, LINE_DDL), write=write, **options)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._table(spark).read(spark)

    def stream(self, spark: SparkSession, max_files: int | None = None) -> DataFrame:
        """The rows with the columns known when the stream starts."""
        return self._table(spark).stream(spark, max_files=max_files)

    def reset(self, spark: SparkSession) -> None:
        """Drop the rows and replay the folder; the columns stay known."""
        StreamTable(self.root, LINE_DDL).reset(spark)


def file_tables(raw: str, root: str, folder_of: Callable[[str, str], str]) -> dict[str, FileTable]:
    """One bronze table per landed folder."""
    return {
        name: FileTable(f"{root}/bronze/{name}", folder_of(raw, name)) for name in S.FILE_TABLES
    }
