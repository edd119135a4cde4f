"""Merging batches into tables: replace, ignore, upsert, refresh, normalise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldcast.operators.commits import CommittedTable

PLAYSTATISTICS_KEYS = ["timestamp", "tbcdid", "project", "deployment", "talkingbookid", "contentid"]
TBSDEPLOYED_KEYS = ["talkingbookid", "deployedtimestamp"]

#: name columns kept in upper case, by table
UPPER_CASE_COLUMNS = {
    "categoriesinpackage": ["contentpackage", "project"],
    "contentinpackage": ["contentpackage", "project"],
    "packagesindeployment": ["contentpackage", "deployment", "project"],
    "surveyevents": ["packageid"],
    "recordevents": ["packageid"],
    "tbdataoperations": ["outimage", "inimage"],
}


def _any_null(keys: list[str]) -> Column:
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return missing


def first_per_key(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``; rows with a NULL key conflict with nothing and all stay.

    The rank limit is applied on the map side before the shuffle, so a key with many copies
    sends one row per task.  NULL-key rows are spread by their place in the input.
    """
    place = F.when(_any_null(keys), F.struct(*order))
    window = Window.partitionBy(*keys, place).orderBy(*order)
    return batch.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of ``batch`` to append: first of each key, and no key the target already has."""
    fresh = first_per_key(batch, keys, order)
    return fresh.join(target.select(*keys), keys, "left_anti").select(*target.columns)


def merge_replace(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Drop target rows the batch has keys for, then add the batch (first row of each key).

    Plain equality, so NULL keys replace nothing.
    """
    kept = target.join(batch.select(*keys).distinct(), keys, "left_anti").select(*target.columns)
    return kept.unionByName(first_per_key(batch, keys, order).select(*target.columns))


def merge_replace_lots(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str], part: str, rows_per_lot: int) -> DataFrame:
    """:func:`merge_replace` within each ``part`` (a column that follows from the keys), in one shuffle of both sides.

    A part is dealt by its keys into as many lots as its largest one needs, and each lot is sorted in one task, where it can be
    written as it is: rows of a key are neighbours there, the batch's first.
    """
    columns = target.columns
    none = [F.lit(None).cast(batch.schema[c].dataType).alias(c) for c in order]
    both = batch.select(*columns, *order, F.lit(0).alias("__side")).unionByName(target.select(*columns, *none, F.lit(1).alias("__side")))
    most = both.groupBy(part).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    unkeyed = _any_null(keys)
    # rows without a whole key conflict with nothing and are spread
    dealt = F.when(unkeyed, F.xxhash64(*columns, *order)).otherwise(F.xxhash64(*keys))
    lots = both.withColumns({"__lot": F.pmod(dealt, F.lit(1 + most // rows_per_lot)), "__alone": F.when(unkeyed, dealt)}).repartition(part, "__lot")
    window = Window.partitionBy(part, "__lot", "__alone", *keys).orderBy("__side", *order)
    ranked = lots.withColumns({"__rank": F.row_number().over(window), "__first": F.first("__side").over(window)})
    return ranked.where(unkeyed | (F.col("__rank") == 1) | (F.col("__first") == 1)).select(*columns)


def merge_playstatistics(target: DataFrame, batch: DataFrame, order: list[str]) -> DataFrame:
    return merge_replace(target, batch, PLAYSTATISTICS_KEYS, order)


def merge_tbsdeployed(target: DataFrame, batch: DataFrame, order: list[str]) -> DataFrame:
    return merge_replace(target, batch, TBSDEPLOYED_KEYS, order)


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """New rows win over stored ones of the same key; columns the batch lacks keep their stored value."""
    given = [c for c in target.columns if c in batch.columns]
    fresh = first_per_key(batch, keys, order).select(*given)
    missing = [c for c in target.columns if c not in batch.columns]
    if missing:
        fresh = fresh.join(target.select(*keys, *missing), keys, "left")
    kept = target.join(batch.select(*keys).distinct(), keys, "left_anti")
    return kept.select(*target.columns).unionByName(fresh.select(*target.columns))


def truncate(table: DataFrame) -> DataFrame:
    """The table without its rows, ready to overwrite the stored one."""
    return table.limit(0)


def truncate_stored(table: "VersionedTable") -> DataFrame:
    """Empty a stored table by a commit of its own."""
    return table.replace(truncate(table.read()))


def normalize_case(table: DataFrame, name: str) -> DataFrame:
    """Upper-case the name columns of a table (no change for tables without any); a table that lacks one of them is an error."""
    columns = UPPER_CASE_COLUMNS.get(name, [])
    absent = [c for c in columns if c not in table.columns]
    if absent:
        raise KeyError(f"{name} lacks {', '.join(absent)}")
    return table.withColumns({c: F.upper(c) for c in columns}) if columns else table


def update_uf_bundles(messages: DataFrame, assigned: DataFrame) -> DataFrame:
    """Set bundle_uuid where (message, program, deployment) is in ``assigned``; others keep theirs."""
    keys = ["message_uuid", "programid", "deploymentnumber"]
    mapping = assigned.select(*keys, F.col("bundle_uuid").alias("__bundle"))
    return (
        messages.join(mapping, keys, "left")
        .withColumn("bundle_uuid", F.coalesce("__bundle", "bundle_uuid"))
        .select(*messages.columns)
    )


def backfill_descriptions(programs: DataFrame, projects: DataFrame) -> DataFrame:
    """Fill in missing program descriptions from the projects table."""
    known = projects.select(F.col("projectcode").alias("program"), F.col("project").alias("__description"))
    return (
        programs.join(known, "program", "left")
        .withColumn("description", F.coalesce("description", "__description"))
        .select(*programs.columns)
    )


class VersionedTable:
    """A Parquet table replaced as a whole; readers see the old or the new version and never half of one."""

    def __init__(self, spark: SparkSession, path: str):
        self._table, self._path = CommittedTable(spark, path), path

    def current(self) -> str | None:
        """Name of the current version, or None before the first write."""
        return self._table.versions().get("all")

    def read(self) -> DataFrame:
        rows = self._table.read()
        if rows is None:
            raise FileNotFoundError(self._path)
        return rows

    def replace(self, frame: DataFrame) -> DataFrame:
        """Write ``frame`` as the new version, then commit it."""
        self._table.commit(frame)
        return self.read()
