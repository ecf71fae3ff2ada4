"""Incrementally read JSON folders: inferred types, new columns, rescued fields, file lineage.

Files are streamed as text and parsed in the plan. The source schema is then always
one text column, so a checkpoint stays valid when the table gains columns; only the
projection after it changes.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"
CORRUPT = "_corrupt_record"

#: A file stream forgets, and from then on ignores, files this much older than the newest
#: it has seen. Spark's default is a week, after which a backfill that keeps its old dates
#: would be skipped without a word; a century keeps them all. The price is a log entry in
#: the checkpoint for every file ever read, so move files that are done to other folders.
MAX_FILE_AGE = "36500d"


def infer_schema(lines: DataFrame) -> T.StructType:
    """Types of the fields of all JSON objects on the lines, from one aggregate.

    Records are read as variants, whose schemas merge: a field of several types, or of
    nothing but nulls, is text, and numbers with a fraction are doubles.
    """
    record = lines.select(F.explode(F.coalesce(records(F.col("value")), F.array("value"))).alias("record"))
    objects = record.where(F.ltrim("record").startswith("{"))
    found = objects.agg(F.schema_of_variant_agg(F.try_parse_json("record"))).first()[0]
    return variant_fields(found)


_VARIANT_TYPE = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<|\bDECIMAL\(\d+,\s*\d+\)|\bVARIANT\b|\bVOID\b|\bOBJECT\b")
_TABLE_TYPE = {"OBJECT<": "STRUCT<", "OBJECT": "STRING", "VARIANT": "STRING", "VOID": "STRING"}


def variant_fields(schema: str) -> T.StructType:
    """A variant's schema as table columns."""

    def replace(found: re.Match) -> str:
        text = found[0]
        # A name that needs no quotes is no type where a colon follows it.
        if text.startswith("`") or schema[found.end() : found.end() + 1] == ":":
            return text
        return "DOUBLE" if text.startswith("DECIMAL") else _TABLE_TYPE[text]

    kind = T._parse_datatype_string(_VARIANT_TYPE.sub(replace, schema))
    return kind if isinstance(kind, T.StructType) else T.StructType([])


def evolve(stored: T.StructType | None, found: T.StructType) -> T.StructType:
    """Add newly seen fields behind the stored ones; a stored type never changes."""
    if stored is None:
        return found
    known = set(stored.fieldNames())
    return T.StructType([*stored.fields, *[field for field in found if field.name not in known]])


def records(line: Column) -> Column:
    """The JSON records on a line: the elements of a top-level array, or the line itself."""
    is_array = F.ltrim(line).startswith("[")
    return F.when(is_array, F.from_json(line, "array<string>")).otherwise(F.array(line))


def parse(lines: DataFrame, schema: T.StructType, *extra: Column) -> DataFrame:
    """Typed columns per JSON record, and in ``_rescued_data`` whatever did not fit.

    Rescued are fields the schema does not know, fields whose text is not of the
    declared type, and records that are not JSON at all. Columns ``extra`` of
    ``lines`` are carried along.
    """
    # An unreadable array keeps its line as one corrupt record.
    listed = F.coalesce(records(F.col("value")), F.array("value"))
    record = lines.where(F.trim("value") != "").select(F.explode(listed).alias("record"), *extra)
    carried = record.columns[1:]
    both = record.select(
        "record",
        F.from_json("record", schema).alias("typed"),
        F.from_json("record", "map<string,string>").alias("raw"),
        *carried,
    )
    fits = [F.col("typed")[name].isNotNull() for name in schema.fieldNames()]
    fitted = F.array_compact(
        F.array(*[F.when(ok, F.lit(name)) for ok, name in zip(fits, schema.fieldNames())])
    )
    # Fitted names are listed once a record, not for each of its fields, and a record whose
    # fields all fit isn't gone through field by field.
    unfitted = F.size(F.array_except(F.map_keys("raw"), fitted)) > 0
    misfits = F.when(
        unfitted,
        F.transform(
            F.array(fitted),
            lambda names: F.map_filter("raw", lambda key, text: text.isNotNull() & ~F.array_contains(names, key)),
        )[0],
    )
    rescued = F.when(F.col("raw").isNull(), F.create_map(F.lit(CORRUPT), F.col("record"))).when(
        F.size(misfits) > 0, misfits
    )
    return both.select(
        *[F.col("typed")[name].alias(name) for name in schema.fieldNames()],
        F.to_json(rescued).alias(RESCUED),
        *carried,
    )


LINEAGE = ("_source_file", "_source_modified_at")


def lineage() -> list[Column]:
    """File path and modification time, to be taken straight from a file scan."""
    return [
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_source_modified_at"),
    ]


def bronze_files(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """A bronze table from the text lines of a JSON folder, batch or stream.

    ``lines`` come straight from a file scan, or have its lineage columns already.
    """
    listed = set(lines.columns)
    origin = [F.col(name) for name in LINEAGE] if listed.issuperset(LINEAGE) else lineage()
    return parse(lines, schema, *origin).select(
        "*", F.current_timestamp().alias("_ingested_at"), F.uuid().alias("_batch_id")
    )


def stream_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """New files of a folder, each read once, at most ``max_files`` per micro-batch."""
    reader = spark.readStream.option("recursiveFileLookup", "true").option("maxFileAge", MAX_FILE_AGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder)


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").text(folder)
