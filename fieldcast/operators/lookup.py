"""Lookups that fill in recipients and deployment numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcast.functions.text import merged

# Directory names that were recorded under another name, by project.
RECIPIENT_OVERRIDES = {
    "MEDA": {
        "KANDANBAMBO B - CHARINGU": "KANDANBAMBO B - CHARIGU",
        "KANYIRI - CHARINGU": "KANYIRI - CHARIGU",
        "KATIMEN-LINYE - FIAN": "KATIMEN - LINYE - FIAN",
        "MWINISUMBO - KULKPONG": "MWINISUMBU - KULKPONG",
        "POGBETIETAA - BUNAA": "POGBATIETAA - BUNAA",
        "POG-OLO - BULEN": "POG - OLO - BULEN",
        "SUNGTAAMAALITAA A - BULEN": "SUNTAAMAALITAA - A - BULEN",
        "TIETAA - IRI - TAFALI": "TIETAA-IRI - TAFALI",
    },
    "UWR": {
        "MOTHER TO MOTHER SUPPORT TAMPAALA": "TAMPAALA-JIRAPA",
        "KABERE-YOUTH TAMPAALA": "TAMPAALA-JIRAPA",
    },
    "CARE": {
        "KPATUA NO": "KPATUA NO 1",
        "SONGO ANONGTAABA": "SONGO ANONGTAABA 1",
    },
}

# Stored columns of a recipient and the names they have in a message's properties.
RECIPIENT_INFO = {
    "recipientid": "recipientid",
    "project": "program",
    "partner": "customer",
    "affiliate": "affiliate",
    "country": "country",
    "region": "region",
    "district": "district",
    "communityname": "community",
    "groupname": "group",
    "agent": "agent",
    "language": "language",
    "listening_model": "listening_model",
}


def _override(project: Column, directory: Column) -> Column:
    entries = [
        F.lit(text)
        for code, names in RECIPIENT_OVERRIDES.items()
        for found, used in names.items()
        for text in (f"{code}\n{found}", used)
    ]
    return F.try_element_at(F.create_map(*entries), F.concat(project, F.lit("\n"), directory))


def recipients_by_directory(rows: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Upper-case (project, directory) -> recipientid; of equal keys the last row by ``order`` wins."""
    folded = rows.withColumn("project", F.upper("project")).withColumn("directory", F.upper("directory"))
    last = F.max_by("recipientid", F.struct(*order)) if order else F.max("recipientid")
    return folded.groupBy("project", "directory").agg(last.alias("recipientid"))


def lookup_recipient(
    rows: DataFrame, recipients: DataFrame, project: Column, directory: Column, strip_quotes: bool = False
) -> DataFrame:
    """Add ``found_recipient``, ``lookup_project``, ``asked_directory``, ``lookup_directory`` and ``override``.

    ``recipients`` is the result of :func:`recipients_by_directory`.  The overrides are a
    literal of a dozen entries; the map is joined, and Spark broadcasts it only while it is small.
    """
    project, directory = F.upper(project), F.upper(directory)
    if strip_quotes:
        project, directory = F.btrim(project, F.lit('"')), F.btrim(directory, F.lit('"'))
    known = recipients.select(
        F.col("project").alias("__project"), F.col("directory").alias("__directory"), F.col("recipientid").alias("found_recipient")
    )
    return (
        rows.withColumn("lookup_project", project)
        .withColumn("asked_directory", directory)
        .withColumn("override", _override(F.col("lookup_project"), F.col("asked_directory")))
        .withColumn("lookup_directory", F.coalesce("override", "asked_directory"))
        .join(
            known,
            (F.col("lookup_project") == F.col("__project")) & (F.col("lookup_directory") == F.col("__directory")),
            "left",
        )
        .drop("__project", "__directory")
    )


def fill_recipient(parsed: DataFrame, recipients: DataFrame) -> DataFrame:
    """Put a recipientid into ``data`` where the key is absent (an empty one counts as present)."""
    data = F.col("data")
    looked_up = lookup_recipient(
        parsed,
        recipients,
        F.try_element_at(data, F.lit("project")),
        F.try_element_at(data, F.lit("community")),
        strip_quotes=True,
    )
    fill = ~F.map_contains_key(data, "recipientid") & (F.coalesce(F.length("found_recipient"), F.lit(0)) > 0)
    return looked_up.withColumn(
        "data",
        F.when(fill, merged(data, F.create_map(F.lit("recipientid"), F.col("found_recipient")))).otherwise(data),
    ).drop("found_recipient", "lookup_project", "asked_directory", "lookup_directory", "override")


def lookup_warnings(looked_up: DataFrame, recipients: DataFrame) -> DataFrame:
    """One row per override used, unknown project and unknown directory, with the number of lines.

    An override is told by the directory that was asked for, an unknown directory by the name looked up.

    ``looked_up`` holds the lines a lookup was made for, as :func:`lookup_recipient` returns them.
    """
    reasons = F.array_compact(
        F.array(
            F.when(F.col("override").isNotNull(), F.lit("override used")),
            F.when(
                F.col("found_recipient").isNull(),
                F.when(F.col("__known"), F.lit("unknown directory")).otherwise(F.lit("unknown project")),
            ),
        )
    )
    counted = (
        looked_up.where(F.col("lookup_project").isNotNull() & F.col("lookup_directory").isNotNull())
        .groupBy("lookup_project", "asked_directory", "lookup_directory", "override", "found_recipient")
        .agg(F.count("*").alias("lines"))
    )
    projects = recipients.select(F.col("project").alias("lookup_project")).distinct().withColumn("__known", F.lit(True))
    return (
        counted.join(projects, "lookup_project", "left")
        .withColumn("__known", F.coalesce("__known", F.lit(False)))
        .select("lookup_project", "asked_directory", "lookup_directory", "lines", F.explode(reasons).alias("reason"))
        .groupBy(
            F.col("lookup_project").alias("project"),
            # an unknown project is reported once, whatever the directory
            F.when(F.col("reason") == "override used", F.col("asked_directory"))
            .when(F.col("reason") == "unknown directory", F.col("lookup_directory"))
            .alias("directory"),
            "reason",
        )
        .agg(F.sum("lines").alias("lines"))
    )


def lookup_recipient_info(rows: DataFrame, recipients: DataFrame, key: str = "recipientid") -> DataFrame:
    """Add a map ``recipient`` of the recipient's attributes under their local names; empty if unknown."""
    entries = F.array(
        *[F.struct(F.lit(local).alias("key"), F.col(stored).cast("string").alias("value")) for stored, local in RECIPIENT_INFO.items()]
    )
    info = recipients.select(
        F.col("recipientid").alias("__recipient"),
        F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("recipient"),
    )
    empty = F.create_map().cast("map<string,string>")
    return (
        rows.join(info, F.col(key) == F.col("__recipient"), "left")
        .withColumn("recipient", F.coalesce("recipient", empty))
        .drop("__recipient")
    )


def lookup_deployment_number(rows: DataFrame, deployments: DataFrame, program: str, deployment: str) -> DataFrame:
    """Add ``found_number``, the (smallest) number of a deployment name within a program."""
    numbers = deployments.groupBy(F.col("project").alias("__program"), F.col("deployment").alias("__deployment")).agg(
        F.min("deploymentnumber").alias("found_number")
    )
    return rows.join(
        numbers, (F.col(program) == F.col("__program")) & (F.col(deployment) == F.col("__deployment")), "left"
    ).drop("__program", "__deployment")
