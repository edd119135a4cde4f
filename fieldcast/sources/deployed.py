"""Rows of ``tbsdeployed`` from deployment logs and from the older operations extract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcast.functions.text import (
    NON_SPECIFIC, UNASSIGNED_SERIAL, UNKNOWN, UNKNOWN_USER, compact_timestamp, coordinates, default_text, last_wins,
    positional_timestamp,
)
from fieldcast.operators.lookup import lookup_recipient

TBSDEPLOYED_COLUMNS = [
    "talkingbookid", "recipientid", "deployedtimestamp", "project", "deployment", "contentpackage", "firmware",
    "location", "coordinates", "username", "tbcdid", "action", "newsn", "testing",
]

# Log key of each column that has another name, and the defaults of optional keys.
LOG_KEYS = {"talkingbookid": "sn", "deployedtimestamp": "timestamp", "contentpackage": "package"}
LOG_DEFAULTS = {"newsn": "f", "testing": "f", "coordinates": ""}
TRUE_WORDS = ("t", "true", "y", "yes", "on", "1")


def _specific(rows: DataFrame, community: str = "community") -> DataFrame:
    return rows.where(F.upper(community) != NON_SPECIFIC)


def count_non_specific(rows: DataFrame, community: str = "community") -> DataFrame:
    """Rows without a real community, per project."""
    return rows.where(F.upper(community) == NON_SPECIFIC).groupBy("project").agg(F.count("*").alias("rows"))


def _to_bool(name: str):
    return F.lower(name).isin(*TRUE_WORDS)


def log_fields(parsed: DataFrame) -> DataFrame:
    """The kept keys of each log line as text columns; NULL where a line lacks the key."""
    data = last_wins(F.col("pairs"))
    rows = parsed.select(data.alias("kept"))
    columns = [*TBSDEPLOYED_COLUMNS, "community"]
    return rows.select(
        *[
            F.coalesce(F.try_element_at("kept", F.lit(LOG_KEYS.get(c, c))), F.lit(LOG_DEFAULTS.get(c))).alias(c)
            for c in columns
        ]
    )


def deployments_from_log(parsed: DataFrame, recipients: DataFrame) -> DataFrame:
    """Log lines (from ``parse_kv``) -> tbsdeployed rows.

    Lines of no specific community, of an unknown recipient or with a key missing are dropped.
    """
    fields = _specific(log_fields(parsed)).withColumn("username", default_text(F.col("username"), UNKNOWN_USER))
    looked_up = lookup_recipient(fields, recipients, F.col("project"), F.col("community"))
    found = F.when(F.length("found_recipient") > 0, F.col("found_recipient"))
    return (
        looked_up.withColumn("recipientid", F.coalesce("recipientid", found))
        .na.drop(subset=TBSDEPLOYED_COLUMNS)
        .withColumn("deployedtimestamp", compact_timestamp(F.col("deployedtimestamp")))
        .withColumn("coordinates", coordinates(F.col("coordinates")))
        .withColumn("newsn", _to_bool("newsn"))
        .withColumn("testing", _to_bool("testing"))
        .select(*TBSDEPLOYED_COLUMNS)
    )


def deployments_from_operations(operations: DataFrame, recipients: DataFrame) -> DataFrame:
    """Operations extract -> tbsdeployed rows; an unknown recipient stays NULL."""
    specific = _specific(operations, "outcommunity")
    looked_up = lookup_recipient(specific, recipients, F.col("project"), F.col("outcommunity"))
    folder = F.col("outsyncdir")
    return looked_up.select(
        default_text(F.col("outsn"), UNKNOWN, UNASSIGNED_SERIAL).alias("talkingbookid"),
        F.col("found_recipient").alias("recipientid"),
        positional_timestamp(F.col("updatedatetime")).alias("deployedtimestamp"),
        "project",
        F.col("outdeployment").alias("deployment"),
        F.col("outimage").alias("contentpackage"),
        default_text(F.col("outfwrev"), UNKNOWN).alias("firmware"),
        "location",
        F.lit(None).cast("struct<latitude:double,longitude:double>").alias("coordinates"),
        F.lit(UNKNOWN).alias("username"),
        F.when(F.length(folder) > 0, F.right(folder, F.lit(4))).otherwise(UNKNOWN).alias("tbcdid"),
        "action",
        F.lit(False).alias("newsn"),
        F.lit(False).alias("testing"),
    )


def operations_extract(tbdataoperations: DataFrame, before: str = "2017Y10M04") -> DataFrame:
    """The operations worth reading: updates from before the deployment logs began (text comparison)."""
    return tbdataoperations.where((F.col("updatedatetime") < before) & F.col("action").ilike("update%")).select(
        "outsn", "updatedatetime", "project", "outdeployment", "outimage", "outcommunity", "outfwrev", "outsyncdir",
        "location", "action",
    )
