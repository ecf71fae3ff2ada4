"""Landing of the files a manifest lists, each in its folder of the raw zone."""

from __future__ import annotations

import re
from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.operators.versions import first_per_key
from fareline.sources.storage import or_none, write_lines

MANIFEST_DDL = "folder_name string, file_name string"
LANDED_DDL = "folder_name string, file_name string, lines bigint, digest string, landed_micros bigint"

#: Entries of one manifest; a larger one is an error, not a shorter landing.
MOST_ENTRIES = 100_000


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest's entries. Folder names lose the trailing dots some entries carry,
    because readers look for the folder without them."""
    entries = spark.read.schema(MANIFEST_DDL).json(path)
    return entries.select(F.rtrim("folder_name", F.lit(".")).alias("folder_name"), "file_name")


def escaped(path: str) -> str:
    """A path that readers take literally."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def listed_lines(spark: SparkSession, source: str, names: list[str]) -> DataFrame:
    """(value, file_name) of the listed files; a name may be a file or a folder of part files."""
    root = source.rstrip("/") + "/"
    # Where the listed name starts in a file's path, which is percent-encoded and may name
    # the file system in another way.
    tail = "/" + re.sub(r"^[A-Za-z0-9+.-]+:/+", "", root).lstrip("/")
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    below = F.substring(path, F.locate(tail, path) + len(tail), F.length(path))
    depth = F.size(F.split(F.col("below"), "/"))
    parents = F.transform(F.sequence(F.lit(1), depth), lambda n: F.array_join(F.slice(F.split("below", "/"), 1, n), "/"))
    reader = spark.read.option("recursiveFileLookup", "true")
    lines = reader.text([escaped(root + name) for name in sorted(names)]).select("value", below.alias("below"))
    listed = F.filter(parents, lambda parent: parent.isin(names))
    return lines.select("value", F.element_at(listed, 1).alias("file_name"))


def content_digests(lines: DataFrame) -> DataFrame:
    """(file_name, lines, digest): what each file holds, whatever the order its lines are read in.

    The digest is two sums of differently seeded 64-bit hashes of the lines, so it takes
    one aggregate that combines before its shuffle, however large a file is.
    """
    hashes = [F.sum(F.xxhash64("value", F.lit(seed)).cast("decimal(20,0)")).cast("string") for seed in ("a", "b")]
    return lines.groupBy("file_name").agg(F.count(F.lit(1)).alias("lines"), F.concat_ws("/", *hashes).alias("digest"))


def landed_folder(raw: str, folder: str) -> str:
    return f"{raw.rstrip('/')}/folder_name={folder}"


def landed_log(raw: str) -> str:
    """Where a raw zone keeps what it has landed; readers of the zone pass by names with a line."""
    return f"{raw.rstrip('/')}/_landed"


def landed_files(spark: SparkSession, raw: str) -> DataFrame:
    """The newest entry of each file that was ever landed; those cleared since have 0 lines."""
    log = or_none(lambda: spark.read.schema(LANDED_DDL).parquet(landed_log(raw)))
    if log is None:
        return spark.createDataFrame([], LANDED_DDL)
    order = [F.desc("landed_micros"), F.col("digest")]
    return first_per_key(log, ["folder_name", "file_name"], order)


def land(spark: SparkSession, manifest: DataFrame, source: str, raw: str) -> DataFrame:
    """Copy every listed file from ``source`` to ``raw/folder_name=<folder>/file_name=<name>``.

    A listed name is relative to ``source``, may lie in sub-folders, and may be a file or
    a folder of part files. Files travel line by line, so a large one is split over tasks,
    and are stored as compressed part files, which Spark's readers take as they take text.
    Landed again, a file is written only if its lines differ from those landed last, so
    streams on the raw zone read it once for each of its contents; files that a folder's
    entries don't name any more, or that are empty now, are cleared, and folders not in the
    manifest stay. A listed file that does not exist fails the job before its folder is
    touched. A landing that dies between writing a folder and its log writes that folder's
    changed files again when it is repeated.

    Two jobs per folder, one of which only digests; the driver holds the manifest, which
    is limited. Returns the log entries of this landing: what was written or cleared.
    """
    entries = manifest.distinct().limit(MOST_ENTRIES + 1).collect()
    if len(entries) > MOST_ENTRIES:
        raise ValueError(f"the manifest lists more than {MOST_ENTRIES} files; split it")
    folders = defaultdict(list)
    for entry in entries:
        folders[entry.folder_name].append(entry.file_name.strip("/"))
    written = [_land_folder(spark, folder, names, source, raw) for folder, names in sorted(folders.items())]
    return reduce(DataFrame.unionByName, written, spark.createDataFrame([], LANDED_DDL))


def _land_folder(spark: SparkSession, folder: str, names: list[str], source: str, raw: str) -> DataFrame:
    before = landed_files(spark, raw).where(F.col("folder_name") == folder).select("file_name", "lines", "digest")
    now = content_digests(listed_lines(spark, source, names))
    # A file without lines has no digest now; one landed with lines before is to be cleared.
    both = now.alias("now").join(before.alias("before"), "file_name", "full")
    differs = ~F.col("now.digest").eqNullSafe(F.col("before.digest"))
    had_or_has = F.coalesce("now.lines", F.lit(0)) + F.coalesce("before.lines", F.lit(0)) > 0
    changed = both.where(differs & had_or_has).select(
        "file_name", F.coalesce("now.lines", F.lit(0)).alias("lines"), F.col("now.digest").alias("digest")
    )
    changed = changed.collect()
    target = landed_folder(raw, folder)
    filled = [row.file_name for row in changed if row.lines]
    if filled:
        write_lines(listed_lines(spark, source, filled), target, "file_name")
    cleared = [row.file_name for row in changed if not row.lines]
    if cleared:
        _clear(spark, target, cleared)
    stamped = F.unix_micros(F.current_timestamp()).alias("landed_micros")
    rows = [(folder, row.file_name, row.lines, row.digest) for row in changed]
    log = spark.createDataFrame(rows, LANDED_DDL.rsplit(",", 1)[0]).select("*", stamped)
    if rows:
        log.coalesce(1).write.mode("append").parquet(landed_log(raw))
    return log


def _clear(spark: SparkSession, target: str, names: list[str]) -> None:
    """Replace landed files by nothing; their folders are found by their names."""
    listed = spark.read.format("binaryFile").option("basePath", target).load(target)
    held = listed.where(F.col("file_name").isin(names)).select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"))
    for row in held.distinct().collect():
        spark.createDataFrame([], "value string").write.mode("overwrite").text(row.folder)
