"""CSV, properties, listings, directories and archives."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldcast.functions.text import directory_timestamp, properties_map
from fieldcast.operators.lookup import recipients_by_directory
from fieldcast.session import send_with_tasks

send_with_tasks(__name__)

# Artifacts of the device loader inside a collection's zip.
ARTIFACTS = ("tbsdeployed.csv", "tbscollected.csv", "stats_collected.properties")
ZIP_NAME = r"/tbcd[^/]*\.zip$"
#: lines that are handed back from Python at once
LINES_PER_FRAME = 10_000


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def csv_by_header(spark: SparkSession, paths: str | list[str]) -> list[DataFrame]:
    """The files as text columns, one frame for each header line that occurs among them.

    Spark takes the first file's header for all files, so files are grouped by their own first line.  That is one
    pass over the lines; file names and headers go to the driver, which lists the files anyway.
    """
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
    )
    first = lines.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    reader = spark.read.option("header", True).option("inferSchema", False)
    return [reader.csv(row["files"]) for row in groups]


def read_csv(spark: SparkSession, paths: str | list[str], schema: StructType | str) -> DataFrame:
    """CSV with a header in each file, read with a given schema; columns are matched by name, whatever their order."""
    rows = spark.createDataFrame([], schema)
    for raw in csv_by_header(spark, paths):
        rows = rows.unionByName(raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in rows.schema]))
    return rows


def read_recipients_map(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """CSV with columns project, directory, recipientid in any order in each file; the last row of a key wins."""
    rows = spark.createDataFrame([], "project string, directory string, recipientid string, file string, block long, line long")
    for raw in csv_by_header(spark, paths):
        rows = rows.unionByName(
            raw.select(
                "project",
                "directory",
                "recipientid",
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("line"),
            )
        )
    return recipients_by_directory(rows, ["file", "block", "line"])


def read_properties(spark: SparkSession, root: str) -> DataFrame:
    """Every ``.properties`` file below ``root`` -> path and map.  Each file is one small record."""
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.properties")
        .text(root, wholetext=True)
    )
    return files.select(F.col("_metadata.file_path").alias("path"), properties_map(F.col("value")).alias("props"))


def parse_listing(lines: DataFrame) -> DataFrame:
    """Object listing lines (``value``) -> uuid and url of the audio files.

    The url is the last word up to its first dot, the uuid the last part of that.
    """
    word = F.element_at(F.split(F.rtrim("value"), r"\s+"), -1)
    return (
        lines.where(F.col("value").rlike(".mp3"))
        .select(F.element_at(F.split(word, r"\."), 1).alias("url"))
        .select(F.element_at(F.split("url", "/"), -1).alias("uuid"), "url")
    )


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    return parse_listing(spark.read.text(path))


def daily_directories(
    files: DataFrame,
    year: str | None = None,
    month: str | None = None,
    day: str | None = None,
    skip: int = 0,
    limit: int | None = None,
) -> DataFrame:
    """Collection directories ``.../yyyy/mm/dd/<stamp>/`` that hold a zip, in path order, from file paths.

    ``skip`` and ``limit`` count directories, to go through an archive piece by piece.
    """
    if day is not None and month is None:
        raise ValueError("a day needs a month")
    place = r"(\d{4})/(\d{2})/(\d{2})/([^/]+)/[^/]+$"
    directories = (
        files.where(F.col("path").rlike(place) & F.lower("path").endswith(".zip"))
        .select(
            F.regexp_extract("path", place, 1).alias("year"),
            F.regexp_extract("path", place, 2).alias("month"),
            F.regexp_extract("path", place, 3).alias("day"),
            F.regexp_replace("path", r"/[^/]+$", "").alias("directory"),
        )
        .withColumn("collected", directory_timestamp(F.regexp_extract("directory", r"[^/]+$", 0)))
    )
    for column, value in (("year", year), ("month", month), ("day", day)):
        if value is not None:
            directories = directories.where(F.col(column) == value)
    directories = directories.distinct()
    if skip or limit is not None:
        directories = directories.orderBy("year", "month", "day", "directory").offset(skip)
    return directories if limit is None else directories.limit(limit)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """path and length of every file below ``root``; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    )


def extension() -> Column:
    return F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))


def accepted_files(files: DataFrame, suffix: str, limit: int | None = None) -> DataFrame:
    """Files with the suffix (any case); the first ``limit`` by path."""
    kept = files.where(extension() == suffix.lower())
    return kept if limit is None else kept.orderBy("path").limit(limit)


def walk_counts(files: DataFrame, suffix: str) -> DataFrame:
    """One row: directories that hold files, files with the suffix, files skipped."""
    wanted = extension() == suffix.lower()
    return files.agg(
        F.count_distinct(F.regexp_replace("path", r"/[^/]+$", "")).alias("n_dirs"),
        F.count_if(wanted).alias("n_files"),
        F.count_if(~wanted).alias("n_skipped"),
    )


def _zip_lines(path: str, content: bytes) -> Iterator[tuple]:
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            for info in archive.infolist():
                member = next((a for a in ARTIFACTS if info.filename.endswith(a)), None)
                if member is None:
                    continue
                lines = archive.read(info).decode("utf-8", errors="replace").splitlines()
                yield from ((path, member, number, line) for number, line in enumerate(lines))
    except (zipfile.BadZipFile, zlib.error, EOFError) as problem:
        yield path, None, -1, str(problem)


def _zip_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    # many lines to a frame: one for each member costs more than reading it; and a bounded number, whatever the zips hold
    rows = chain.from_iterable(
        _zip_lines(path, content) for batch in batches for path, content in zip(batch["path"], batch["content"])
    )
    while lot := list(islice(rows, LINES_PER_FRAME)):
        yield pd.DataFrame(lot, columns=["path", "member", "line_no", "line"])


def zip_artifacts(zips: DataFrame, loose: DataFrame | None = None) -> DataFrame:
    """Lines of the loader artifacts inside zips (``path``, ``content``).

    A zip that cannot be read gives a row without a member, with line number -1 and the error as its line.

    ``loose`` (path, member, line_no, line) are artifacts that already lie in the directory
    as files: they are used instead of the zip's member of that name.
    """
    inside = (
        zips.select("path", "content")
        .mapInPandas(_zip_members, "path string, member string, line_no bigint, line string")
        .withColumn("directory", F.regexp_replace("path", r"/[^/]+$", ""))
        .drop("path")
    )
    columns = ["directory", "member", "line_no", "line"]
    if loose is None:
        return inside.select(*columns)
    found = loose.withColumn("directory", F.regexp_replace("path", r"/[^/]+$", ""))
    kept = inside.join(found.select("directory", "member").distinct(), ["directory", "member"], "left_anti")
    return kept.select(*columns).unionByName(found.select(*columns))


def read_zip_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """Loader artifacts of every collection directory below ``root``."""
    binary = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    zips = binary.option("pathGlobFilter", "tbcd*.zip").load(root)
    loose = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "{" + ",".join(ARTIFACTS) + "}")
        .text(root, wholetext=True)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.posexplode(F.split(F.regexp_replace("value", r"\r?\n$", ""), "\r?\n")).alias("line_no", "line"),
        )
        .withColumn("member", F.regexp_extract("path", r"[^/]+$", 0))
        .withColumn("line_no", F.col("line_no").cast("bigint"))
    )
    return zip_artifacts(zips, loose)


def drop_listed_devices(rows: DataFrame, lines: DataFrame, column: str = "tbcdid") -> DataFrame:
    """Without the loader ids of a block list (``value`` lines ``id # remark``), in any case."""
    listed = (
        lines.select(F.lower(F.trim(F.regexp_replace("value", "#.*$", ""))).alias("__listed"))
        .where(F.length("__listed") > 0)
        .distinct()
    )
    return rows.join(listed, F.lower(column) == F.col("__listed"), "left_anti")
