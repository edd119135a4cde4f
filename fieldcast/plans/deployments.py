"""Reports on how content was deployed to devices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldcast.functions.pg import concat_skip_null, text_list
from fieldcast.operators.names import ilike_join
from fieldcast.operators.summary import distinct_summary
from fieldcast.tables import Tables, mart


@mart
def program_info(t: Tables) -> DataFrame:
    return t["projects"].select(F.col("projectcode").alias("project"), F.col("project").alias("description"))


@mart
def project_list(t: Tables) -> DataFrame:
    """Active projects and the folder their reports go to."""
    return (
        t["projects"]
        .where("id >= 0")
        .select(F.col("projectcode").alias("project"), F.concat("projectcode", F.lit("/")).alias("path"))
    )


@mart
def tbs_deployed_info(t: Tables) -> DataFrame:
    """Distinct deployments of a device to a recipient.

    Both inputs are made distinct before they meet, so the join result needs no second shuffle.
    """
    deployed = (
        t["tbsdeployed"]
        .where(F.col("recipientid").isNotNull())
        .select("project", "deployment", F.col("contentpackage").alias("package"), "recipientid", "talkingbookid")
        .distinct()
    )
    people = (
        t["recipients"]
        .select("recipientid", "communityname", "groupname", F.col("language").alias("languagecode"))
        .distinct()
    )
    return deployed.join(people, "recipientid").select(
        "project", "deployment", "package", "recipientid", "communityname", "groupname", "languagecode", "talkingbookid"
    )


def deployment_rows(t: Tables) -> DataFrame:
    """``deployment_info`` before its DISTINCT; enough for counts of distinct values."""
    schedule = t["deployments"].select(
        "project", F.col("deployment").alias("deployment_name"), "deploymentnumber", "startdate", "enddate"
    ).distinct()
    joined = ilike_join(
        t["tbs_deployed_info"],
        schedule,
        ["project"],
        "deployment",
        "deployment_name",
        pattern_side="left",
        how="left",
        wildcards=t.wildcards("tbsdeployed", "deployment"),
    )
    return joined.select(
        "project", "deployment", "deploymentnumber", "package", "languagecode", "startdate", "enddate",
        "recipientid", "communityname", "groupname", "talkingbookid",
    )


@mart
def deployment_info(t: Tables) -> DataFrame:
    return deployment_rows(t).distinct()


def _deployment_input(t: Tables) -> DataFrame:
    return t["deployment_info"] if t.stored("deployment_info") else deployment_rows(t)


@mart
def deployments_by_deployment(t: Tables) -> DataFrame:
    return distinct_summary(
        _deployment_input(t),
        ["project", "deploymentnumber", "startdate", "enddate"],
        counts={
            "num_packages": "package",
            "num_languages": "languagecode",
            "num_communities": "communityname",
            "num_recipients": "recipientid",
            "deployed_tbs": "talkingbookid",
        },
        lists={"deployment": "deployment"},
        spread="talkingbookid",
    ).select(
        "project", "deployment", "deploymentnumber", "startdate", "enddate", "num_packages", "num_languages",
        "num_communities", "num_recipients", "deployed_tbs",
    )


@mart
def deployments_by_community(t: Tables) -> DataFrame:
    return (
        _deployment_input(t)
        .groupBy(
            "project", "deployment", "deploymentnumber", "startdate", "enddate", "package", "recipientid", "communityname"
        )
        .agg(F.count_distinct("talkingbookid").alias("deployed_tbs"))
        .withColumn("community", F.col("communityname"))
    )


@mart
def deployments_by_package(t: Tables) -> DataFrame:
    """Communities and devices per package, with the language's name."""
    names = t["languages"].select(
        F.col("projectcode").alias("project"), F.col("languagecode").alias("known_code"), "language"
    )
    counted = (
        _deployment_input(t)
        .groupBy("project", "deployment", "deploymentnumber", "startdate", "enddate", "package", "languagecode")
        .agg(
            F.count_distinct("communityname").alias("num_communities"),
            F.count_distinct("talkingbookid").alias("deployed_tbs"),
        )
    )
    return (
        ilike_join(
            counted, names, ["project"], "languagecode", "known_code", "left",
            wildcards=t.wildcards("recipients", "language"),
        )
        .drop("known_code")
        .distinct()
    )


@mart
def update_operation_info(t: Tables) -> DataFrame:
    return (
        t["tbdataoperations"]
        .where(F.col("action").ilike("update%"))
        .select(
            "project",
            F.col("outdeployment").alias("deployment"),
            F.col("outimage").alias("package"),
            F.col("outcommunity").alias("community"),
            F.col("outsn").alias("talkingbook"),
        )
        .distinct()
    )


@mart
def deployments_by_updateoperation(t: Tables) -> DataFrame:
    """Packages per device; straight from the operations, as a distinct count ignores repeats."""
    return (
        t["tbdataoperations"]
        .where(F.col("action").ilike("update%"))
        .groupBy("project", F.col("outcommunity").alias("community"), F.col("outsn").alias("talkingbook"))
        .agg(F.count_distinct("outimage").alias("num_packages"))
    )


@mart
def deployments_by_talkingbook(t: Tables) -> DataFrame:
    """Deployed devices with recipient and deployment; ``coordinates`` only where the table has them, all else must be there."""
    people = t["recipients"].select(
        "recipientid", "partner", "affiliate", "communityname", "groupname", "country", "region", "district"
    )
    schedule = t["deployments"].select("project", "deployment", "deploymentnumber")
    joined = t["tbsdeployed"].join(people, "recipientid").join(schedule, ["project", "deployment"])
    wanted = [
        "partner", "affiliate", "communityname", "groupname", "country", "region", "district", "talkingbookid",
        "recipientid", "deployedtimestamp", "project", "deployment", "deploymentnumber", "contentpackage", "firmware",
        "location", "coordinates", "username", "tbcdid", "action", "newsn", "testing",
    ]
    present = [c for c in wanted if c != "coordinates" or c in joined.columns]
    return joined.select(*present)


@mart
def deployments_by_recipient(t: Tables) -> DataFrame:
    return distinct_summary(
        t["deployments_by_talkingbook"],
        [
            "project", "deploymentnumber", "partner", "affiliate", "communityname", "groupname", "country", "region",
            "district", "recipientid",
        ],
        counts={"num_tbs": "talkingbookid"},
        lists={"deployment": "deployment"},
    )


@mart
def deployment_date_mismatch(t: Tables) -> DataFrame:
    """Deployment numbers whose start or end is not one single date (all-NULL dates count as none)."""
    return (
        t["deployments"]
        .groupBy("project", "deploymentnumber")
        .agg(
            text_list(F.col("deployment")).alias("deployments"),
            F.count_distinct("startdate").alias("numstarts"),
            F.count_distinct("enddate").alias("numends"),
        )
        .where("numstarts <> 1 OR numends <> 1")
    )


@mart
def deployment_spec(t: Tables) -> DataFrame:
    short_year = F.year("startdate") % 100
    return (
        t["deployments"]
        .select(
            "project",
            F.col("deploymentnumber").alias("deployment_num"),
            "startdate",
            "enddate",
            "component",
            concat_skip_null(
                F.col("project"), F.lit("-"), short_year, F.lit("-"), F.col("deploymentnumber")
            ).alias("name"),
        )
        .distinct()
    )


def latest_per_project(df: DataFrame, keep: int = 4) -> DataFrame:
    """The ``keep`` newest rows of each project.

    An unknown start date sorts first, as in PostgreSQL.  Spark prunes to ``keep`` rows per
    project on the map side before the shuffle, so a project's size does not matter.
    """
    newest = Window.partitionBy("project").orderBy(
        F.col("startdate").desc_nulls_first(),
        F.col("deploymentnumber").desc_nulls_first(),
        F.col("deployment").asc_nulls_last(),
    )
    return df.withColumn("__rank", F.row_number().over(newest)).where(F.col("__rank") <= keep).drop("__rank")


@mart
def deployment_dashboard(t: Tables) -> DataFrame:
    numbered = t["deployments_by_deployment"].where("deploymentnumber > 0")
    return latest_per_project(numbered).select(
        "project", "deployment", "deploymentnumber", "startdate", "enddate", "num_packages", "num_languages",
        "num_communities", "deployed_tbs",
    )
