"""Reports on the content that was produced for each deployment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcast.functions.pg import round_ratio
from fieldcast.operators.names import ilike_join
from fieldcast.operators.summary import distinct_summary
from fieldcast.tables import Tables, mart


@mart
def production_info(t: Tables) -> DataFrame:
    """Every message of every package of every deployment.

    The content list, the one big input, takes the dimensions one at a time.  Each is a
    plain table whose size Spark knows, so small ones are broadcast and the list stays put.
    """
    schedule = t["deployments"].select("project", "deployment", "deploymentnumber")
    packages = t["packagesindeployment"].select(
        "project",
        F.col("deployment").alias("p_deployment"),
        "startdate",
        F.col("contentpackage").alias("package"),
        "languagecode",
    )
    names = t["languages"].select(F.col("projectcode").alias("project"), F.col("languagecode").alias("l_code"), "language")
    content = t["contentinpackage"].select(
        "project", F.col("contentpackage").alias("c_package"), "categoryid", "contentid"
    )
    categories = t["categories"].select(
        F.col("projectcode").alias("project"), F.col("categoryid").alias("k_category"), "categoryname"
    )
    metadata = t["contentmetadata2"].select(
        "project", F.col("contentid").alias("m_content"), "format", "duration_sec", "title"
    )
    listed = ilike_join(
        content, packages, ["project"], "c_package", "package", "right",
        wildcards=t.wildcards("packagesindeployment", "contentpackage"),
    )
    listed = ilike_join(
        listed, schedule, ["project"], "p_deployment", "deployment", "right",
        wildcards=t.wildcards("deployments", "deployment"),
    )
    listed = ilike_join(
        listed, names, ["project"], "languagecode", "l_code", "left",
        wildcards=t.wildcards("packagesindeployment", "languagecode"),
    )
    listed = ilike_join(
        listed, categories, ["project"], "categoryid", "k_category", "left",
        wildcards=t.wildcards("contentinpackage", "categoryid"),
    )
    listed = ilike_join(
        listed, metadata, ["project"], "contentid", "m_content", "left",
        wildcards=t.wildcards("contentinpackage", "contentid"),
    )
    return listed.select(
        "project", "deployment", "deploymentnumber", "startdate", "package", "languagecode", "language", "categoryid",
        "categoryname", "contentid", "format", "duration_sec", "title",
    )


def production_by_deployment(t: Tables, fix_fanout: bool = False) -> DataFrame:
    """Packages, messages and minutes per deployment number.

    The package and category counts are kept per deployment *name* but matched on the
    number alone, so with several names per number each message counts names x names times
    in the minutes.  That factor is applied to finished sums instead of to rows;
    ``fix_fanout`` leaves it out.
    """
    # both sides start from the same reduced rows, so the chain of joins runs and is shuffled once
    info = t["production_info"].select(
        "project", "deployment", "deploymentnumber", "startdate", "package", "languagecode", "categoryname", "contentid",
        "duration_sec",
    ).distinct()
    messages = info.select(
        "project", "deployment", "deploymentnumber", "startdate", "contentid", "duration_sec"
    ).distinct()
    message_sums = distinct_summary(
        messages,
        ["project", "deploymentnumber", "startdate"],
        counts={"num_messages": "contentid"},
        lists={"deployment": "deployment"},
        sums={"seconds": "duration_sec"},
    )
    per_number = (
        info.where(F.col("deploymentnumber").isNotNull())
        .groupBy("project", "deploymentnumber", "deployment")
        .agg(
            F.count_distinct("package").alias("packages"),
            F.count_distinct("languagecode").alias("languages"),
            F.count_distinct("categoryname").alias("categories"),
        )
        .groupBy("project", "deploymentnumber")
        .agg(
            F.max("packages").alias("num_packages"),
            F.max("languages").alias("num_languages"),
            F.max("categories").alias("num_categories"),
            F.count("*").alias("names"),
        )
    )
    factor = F.lit(1) if fix_fanout else F.col("names") * F.col("names")
    return message_sums.join(per_number, ["project", "deploymentnumber"]).select(
        "project", "deployment", "deploymentnumber", "startdate", "num_packages", "num_languages", "num_categories",
        "num_messages", round_ratio(F.col("seconds") * factor, 60, 1).alias("duration_minutes"),
    )


mart(production_by_deployment)


@mart
def production_by_package(t: Tables) -> DataFrame:
    """Categories, messages and minutes per package.

    Messages and categories are summed up separately and meet as one row per package.
    """
    keys = ["project", "deployment", "deploymentnumber", "startdate", "package", "languagecode", "language"]
    # reduced once for both sides
    info = t["production_info"].select(*keys, "categoryid", "contentid", "duration_sec").distinct()
    messages = (
        info.select(*keys, "contentid", "duration_sec")
        .distinct()
        .groupBy(*keys)
        .agg(
            F.count_distinct("contentid").alias("messages"),
            F.count("contentid").alias("entries"),
            F.sum("duration_sec").alias("seconds"),
        )
    )
    categories = (
        info.groupBy("project", F.col("deployment").alias("k_deployment"), "deploymentnumber", F.col("package").alias("k_package"))
        .agg(F.count_distinct("categoryid").alias("categories"))
        .drop("deploymentnumber")
    )
    wild = t.wildcards("packagesindeployment", "contentpackage") or t.wildcards("deployments", "deployment")
    if wild:
        matched = ilike_join(categories, messages, ["project"], "k_package", "package", "right").where(
            F.expr("k_deployment ILIKE deployment")
        )
    else:
        matched = categories.withColumn("k_deployment", F.lower("k_deployment")).withColumn(
            "k_package", F.lower("k_package")
        ).join(
            messages.withColumn("k_deployment", F.lower("deployment")).withColumn("k_package", F.lower("package")),
            ["project", "k_deployment", "k_package"],
        )
    return (
        matched.groupBy(*keys)
        .agg(
            F.max("categories").alias("num_categories"),
            F.max("messages").alias("num_messages"),
            F.sum("entries").alias("all_messages"),
            F.sum("seconds").alias("seconds"),
        )
        .select(
            *keys, "num_categories", "num_messages", "all_messages",
            round_ratio(F.col("seconds"), 60, 1).alias("duration_minutes"),
        )
    )


@mart
def production_by_category(t: Tables) -> DataFrame:
    return (
        t["production_info"]
        .groupBy(
            "project", "deployment", "deploymentnumber", "startdate", "package", "languagecode", "language",
            "categoryid", "categoryname",
        )
        .agg(
            F.count_distinct("contentid").alias("num_messages"),
            round_ratio(F.sum("duration_sec"), 60, 1).alias("duration_minutes"),
        )
    )
