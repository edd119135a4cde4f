"""Retired reports over the older statistics.

They compare package names exactly, so they expect names normalised to upper case
(:func:`fieldcast.operators.merge.normalize_case`).  Parameters left at None select everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldcast.functions.pg import category_label, int_div, met_where_dealt, round_ratio, same
from fieldcast.tables import Tables, mart


def only(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Keep rows whose columns equal the parameters that were given."""
    for column, value in wanted.items():
        if value is not None:
            df = df.where(F.col(column) == value)
    return df


def all_stats_for_deployment(t: Tables, project: str | None = None) -> DataFrame:
    """Totals per deployment; summed per package first, so packages and deployments meet as summaries."""
    sums = {
        "effectivecompletions": "effectivecompletions_max",
        "started": "started_max",
        "quarter": "quarter_max",
        "half": "half_max",
        "threequarters": "threequarters_max",
        "completed": "completed_max",
        "completed_logevents": "completed_logevents",
        "completed_logs": "completed_logs",
        "completed_stats": "completed_stats",
        "completed_flash": "completed_flash",
        "completed_min": "completed_min",
        "completed_variance": "completed_variance",
    }
    per_package = (
        only(t["allsources_s"], project=project)
        .groupBy("project", "contentpackage")
        .agg(F.sum("played_seconds_max").alias("seconds"), *[F.sum(c).alias(n) for n, c in sums.items()])
    )
    packages = t["packagesindeployment"].select("contentpackage", "deployment", "startdate")
    return (
        per_package.join(packages, "contentpackage")
        .groupBy("project", "deployment", "startdate")
        .agg(F.sum("seconds").alias("seconds"), *[F.sum(n).alias(n) for n in sums])
        .select(
            "project", "deployment", "startdate", (F.col("seconds") / F.lit(3600.0)).alias("hoursplayed"), *sums,
            F.col("completed").alias("completed_max"),
        )
    )


def community_completions(
    t: Tables, datasource: int, measure: str = "stats", project: str | None = None
) -> DataFrame:
    """Completions and completions per device by village and package, for one kind of counters."""
    counters = t["syncaggregation"].where(F.col("datasource") == datasource).select(
        "contentid", "contentpackage", "village", "talkingbook", "countcompleted"
    )
    content = only(t["contentinpackage"], project=project).select("project", "contentid", "contentpackage")
    villages = t["communities"].select("project", F.col("communityname").alias("village"))
    packages = t["packagesindeployment"].select("project", "contentpackage", "startdate")
    total = F.sum("countcompleted")
    return (
        counters.join(content, ["contentid", "contentpackage"])
        .join(villages, ["project", "village"])
        .join(packages, ["project", "contentpackage"])
        .groupBy("project", "village", "startdate", "contentpackage")
        .agg(F.count_distinct("talkingbook").alias("TBs"), total.alias(measure))
        .withColumn("ComplPerTB", int_div(F.col(measure), F.col("TBs")))
        .drop("startdate")
    )


@mart
def community_completions_flash(t: Tables) -> DataFrame:
    return community_completions(t, 3, "FlashStats")


@mart
def community_completions_stats(t: Tables) -> DataFrame:
    return community_completions(t, 2, "stats")


def _stats_against_flash(t: Tables, *by: str) -> DataFrame:
    counters = t["syncaggregation"].where(F.col("datasource").isin(2, 3)).select(
        "contentid", "contentpackage", "datasource", "talkingbook", "countcompleted", "totaltimeplayed"
    )
    content = t["contentinpackage"].select("project", "contentid", "contentpackage")
    packages = t["packagesindeployment"].select("project", "contentpackage", "deployment")
    total = F.col("completed")
    return (
        counters.join(content, ["contentid", "contentpackage"])
        .join(packages, ["project", "contentpackage"])
        .groupBy(*by, "datasource")
        .agg(
            F.count_distinct("talkingbook").alias("TBs"),
            F.sum("countcompleted").alias("completed"),
            F.sum("totaltimeplayed").alias("seconds"),
        )
        .select(
            *by, "TBs",
            F.when(F.col("datasource") == 2, total).otherwise(0).alias("stats"),
            F.when(F.col("datasource") == 3, total).otherwise(0).alias("flash"),
            int_div(F.col("seconds"), 3600).alias("Played_Hours_Flash"),
        )
    )


@mart
def compare_stats_flash_by_deployment(t: Tables) -> DataFrame:
    return _stats_against_flash(t, "project", "deployment")


@mart
def compare_stats_flash_by_package(t: Tables) -> DataFrame:
    return _stats_against_flash(t, "project", "deployment", "contentpackage")


def _listed_plays(t: Tables, *keys: str) -> DataFrame:
    """Plays of messages that are on their package's list (semi join on ``keys``)."""
    return t["allsources_s"].join(t["contentinpackage"].select(*keys).distinct(), list(keys), "left_semi")


def _first(*by: str) -> Column:
    """Marks one row of each message of a package, so that a later sum of the marks counts messages."""
    return F.row_number().over(Window.partitionBy("contentid", "contentpackage", "project").orderBy(*by)) == 1


def msgs_played_each_tb(t: Tables, project: str | None = None, package: str | None = None) -> DataFrame:
    """Messages each device played, beside all messages played of the package."""
    plays = only(_listed_plays(t, "contentid", "contentpackage", "project"), project=project, contentpackage=package)
    heard = plays.select("project", "contentpackage", "contentid", "talkingbook", "village").distinct()
    devices = (
        heard.withColumn("first", _first("talkingbook", "village"))
        .groupBy("project", "contentpackage", "talkingbook", "village")
        .agg(F.count("contentid").alias("msgsplayed"), F.count_if("first").alias("firsts"))
    )
    totals = devices.groupBy("project", "contentpackage").agg(F.sum("firsts").alias("msgstotal"))
    return devices.drop("firsts").join(totals, ["project", "contentpackage"])


def package_stats(t: Tables, project: str | None = None) -> DataFrame:
    """Key figures of each package, and the shares of devices that played all, half or fewer of its messages.

    A share with no device in it is NULL, not 0.  Plays are summed up by message and device where they meet the list, then by
    device, then by the number of messages played: one row after the other, so all figures come from one pass.
    """
    by = ["project", "contentpackage"]
    listed = t["contentinpackage"].groupBy("contentpackage", "contentid").agg(F.collect_set("project").alias("projects"))
    plays = (
        only(t["allsources_s"], project=project)
        .join(listed, ["contentid", "contentpackage"])
        .withColumn("own", F.coalesce(F.array_contains("projects", F.col("project")), F.lit(False)))
    )
    sums = {"timeplayed": "played_seconds_max", "effective": "effectivecompletions_max", "completed": "completed_max"}
    heard = plays.groupBy(*by, "contentid", "talkingbook", "own").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    devices = (
        heard.withColumn("first", _first("talkingbook"))
        .groupBy(*by, "talkingbook")
        .agg(
            F.count_if("own").alias("played"),
            F.count_if("first").alias("msgs"),
            F.count_if(F.col("first") & F.col("own")).alias("messages"),
            *[F.sum(n).alias(n) for n in sums],
        )
    )
    # how many devices played how many messages: a few rows per package
    figures = ["msgs", "messages", *sums]
    content = devices.groupBy(*by, "played").agg(
        F.count("*").alias("devices"), F.count("talkingbook").alias("tbs"), *[F.sum(n).alias(n) for n in figures]
    )
    package = Window.partitionBy(*by)
    content = content.withColumns({n: F.sum(n).over(package) for n in ("tbs", *figures)})
    minutes = (
        t["contentinpackage"].select("contentpackage", "contentid")
        .join(t["contentmetadata2"].select("contentid", "duration_sec"), "contentid")
        .groupBy("contentpackage")
        .agg(int_div(F.sum("duration_sec"), 60).alias("duration_min"))
    )
    played, messages = F.col("played"), F.col("messages")

    def devices_with(condition: Column) -> Column:
        return F.sum(F.when((played > 0) & condition, F.col("devices")))

    content = (
        content.groupBy(*by, "tbs", *figures)
        .agg(
            devices_with(played == messages).alias("all_of"),
            devices_with((played * 2 >= messages) & (played != messages)).alias("half_of"),
            devices_with(played * 2 < messages).alias("less_of"),
        )
    )
    packages = t["packagesindeployment"].select(*by, "deployment", "packagename", "startdate")

    def share(name: str) -> Column:
        return round_ratio(F.col(name), F.col("tbs"), 2)

    return (
        content.join(minutes, "contentpackage", "left")
        .join(packages, by)
        .select(
            "project", "deployment", "contentpackage", "packagename", "startdate",
            round_ratio(F.col("timeplayed"), 3600, 1).alias("hoursplayed"),
            "msgs", "duration_min",
            round_ratio(F.col("timeplayed"), F.col("tbs") * 3600, 0).alias("hourspertb"),
            "completed",
            round_ratio(F.col("completed"), F.col("tbs") * F.col("msgs"), 1).alias("completionspertbpermsg"),
            round_ratio(F.col("effective"), F.col("tbs"), 1).alias("effcompletionspertb"),
            F.col("tbs").alias("tbcount"),
            share("all_of").alias("tbsplayingallmsgspct"),
            share("half_of").alias("tbsplayinghalfnotallmsgspct"),
            share("less_of").alias("tbsplayinglessthanhalfmsgspct"),
        )
        .distinct()
    )


def tb_count_community_package(t: Tables, project: str | None = None) -> DataFrame:
    """Devices per community and package; communities without any play stay, with a count of 0."""
    villages = only(t["communities"], project=project).select("project", "communityname")
    devices = t["allsources_s"].select("village", "contentpackage", "talkingbook").distinct()
    return (
        villages.join(devices, villages["communityname"] == devices["village"], "left")
        .groupBy("project", "village", "contentpackage")
        .agg(F.count_distinct("talkingbook").alias("TBs"))
    )


def _titled(rows: DataFrame, t: Tables, *wanted: str | Column) -> DataFrame:
    """Rows with the metadata of their message; the join is on the message alone, so rows dealt by it stay where they are."""
    metadata = t["contentmetadata2"].select(F.col("project").alias("__project"), F.col("contentid").alias("__content"), *wanted)
    met = rows.join(metadata.repartition("__content"), (F.col("contentid") == F.col("__content")) & same("project", "__project"))
    return met.drop("__content", "__project")


def _content_list(t: Tables, project: str | None) -> DataFrame:
    content = only(t["contentinpackage"], project=project).select(
        "project", "contentpackage", "contentid", "categoryid", F.col("position").alias("order")
    )
    titled = _titled(
        content.repartition("contentid"), t, "title", "format", int_div(F.col("duration_sec"), 60).alias("length_minutes"),
        "languagecode", "source", "keywords", F.col("categories").alias("acm_categories"), "transcriptionurl", "notes",
    )
    named = t["categories"].select(
        F.col("projectcode").alias("project"), "categoryid", category_label(F.col("categoryname")).alias("category")
    )
    return titled.join(named, ["project", "categoryid"])


def _contents(listed: DataFrame, packages: DataFrame, label: str) -> DataFrame:
    return (
        listed.join(packages, "contentpackage")
        .select(
            "title", label, "category", "order", "format", "length_minutes", "languagecode", "source", "keywords",
            "acm_categories", "transcriptionurl", "notes",
        )
        .distinct()
    )


def contents_by_deployment(t: Tables, project: str | None = None, deployment: str | None = None) -> DataFrame:
    packages = only(t["packagesindeployment"], deployment=deployment).select("contentpackage", "deployment").distinct()
    return _contents(_content_list(t, project), packages, "deployment")


def contents_by_package(t: Tables, project: str | None = None, package: str | None = None) -> DataFrame:
    listed = only(_content_list(t, project), contentpackage=package)
    packages = t["packagesindeployment"].select("contentpackage", "packagename").distinct()
    return _contents(listed, packages, "packagename")


def _package_devices(t: Tables) -> DataFrame:
    """Devices of each package: one short row a package, whose number Spark cannot know beforehand."""
    return F.broadcast(
        t["allsources_s"].groupBy("project", "contentpackage").agg(F.count_distinct("talkingbook").alias("pkgtbs"))
    )


def _message_totals(plays: DataFrame, *by: str) -> DataFrame:
    return plays.groupBy(*by).agg(
        F.sum("played_seconds_max").alias("timeplayed"),
        F.sum("effectivecompletions_max").alias("effective"),
        F.sum("completed_max").alias("completed"),
        F.count_distinct("talkingbook").alias("tbs"),
    )


def _message_measures() -> list[Column]:
    done = F.col("completed")
    extra = (F.col("effective") - done) * 100
    return [
        round_ratio(F.col("timeplayed"), F.col("pkgtbs") * 60, 0).alias("minutes_per_tb"),
        round_ratio(F.col("effective"), F.col("pkgtbs"), 1).alias("eff_completions_per_tb"),
        round_ratio(F.col("timeplayed"), 60, 0).alias("total_minutes_played"),
        done.alias("total_completions"),
        F.col("effective").alias("total_effective_completions"),
        F.when(done > 0, round_ratio(extra, F.when(done > 0, done), 0)).otherwise(0.0).alias("partial_percentage"),
        F.col("tbs"),
        F.col("pkgtbs"),
        int_div(F.col("tbs") * 100, F.col("pkgtbs")).alias("TB%"),
    ]


def top_msgs_by_deployment(t: Tables, project: str | None = None, deployment: str | None = None) -> DataFrame:
    """Messages of a deployment with their play figures; order by total_effective_completions for the ranking.

    Figures are per package of the plays, and are listed beside every package of the deployment.
    """
    packages = t["packagesindeployment"].select("contentpackage", "deployment")
    totals = _message_totals(only(t["allsources_s"], project=project), "project", "contentpackage", "contentid")
    # a package listed several times under one deployment multiplies its sums
    times = only(packages, deployment=deployment).groupBy("contentpackage", "deployment").agg(F.count("*").alias("times"))
    stats = (
        totals.join(_package_devices(t), ["project", "contentpackage"])
        .join(times, "contentpackage")
        .withColumns({c: F.col(c) * F.col("times") for c in ("timeplayed", "effective", "completed")})
        .drop("contentpackage", "times")
    )
    content = t["contentinpackage"].select(
        F.col("project").alias("projectcode"), "contentpackage", "contentid", "categoryid", F.col("position").alias("order")
    )
    named = t["categories"].select("projectcode", "categoryid", category_label(F.col("categoryname")).alias("category"))
    listed = (
        only(packages, deployment=deployment).distinct()
        .join(content, "contentpackage")
        .join(named, ["projectcode", "categoryid"])
        .select(F.col("deployment").alias("__deployment"), "contentpackage", F.col("contentid").alias("__listed"), "category", "order")
        .repartition("__listed")
        .distinct()
    )
    titled = _titled(stats, t, "title", "format", int_div(F.col("duration_sec"), 60).alias("length_minutes"))
    # both sides are dealt by message; a message has at most as many rows in either as there are packages
    return (
        met_where_dealt(titled, listed, ("contentid", "__listed"), [("deployment", "__deployment")])
        .select(
            "title", F.concat(F.lit("d"), "deployment").alias("Deployment"), "contentpackage", "category", "order",
            "format", "length_minutes", *_message_measures(),
        )
        .distinct()
    )


@mart
def topmsgsbypkgall_s(t: Tables) -> DataFrame:
    """Play figures of every message in every package."""
    totals = _message_totals(t["allsources_s"], "project", "contentpackage", "contentid")
    names = t["packagesindeployment"].groupBy("project", "contentpackage").agg(F.min("packagename").alias("package"))
    listed = _content_list(t, None).select(
        F.col("project").alias("__project"), F.col("contentpackage").alias("__package"), F.col("contentid").alias("__listed"),
        "title", "category", "order", "format", "length_minutes",
    )
    # both sides are dealt by message; a message has at most as many rows in either as there are packages
    here = [("project", "__project"), ("contentpackage", "__package")]
    return (
        met_where_dealt(totals, listed, ("contentid", "__listed"), here)
        .join(_package_devices(t), ["project", "contentpackage"])
        .join(names, ["project", "contentpackage"])
        .select("project", "contentpackage", "title", "package", "category", "order", "format", "length_minutes", *_message_measures())
        .withColumnRenamed("TB%", "pct_tb_completions")
    )


def top_msgs_by_package(t: Tables, project: str | None = None, package: str | None = None) -> DataFrame:
    return only(t["topmsgsbypkgall_s"], project=project, contentpackage=package).select(
        "title", F.col("package").alias("Package"), "category", "order", "format", "length_minutes", "minutes_per_tb",
        "eff_completions_per_tb", "total_minutes_played", "total_completions", "total_effective_completions",
        "partial_percentage", "tbs", "pkgtbs", F.col("pct_tb_completions").alias("TB%"),
    )


def ordered(df: DataFrame, *columns: str) -> DataFrame:
    """Sort for output: ``-name`` is descending with NULLs first, others ascending with NULLs last, as in PostgreSQL."""
    return df.orderBy(
        *[F.col(c[1:]).desc_nulls_first() if c.startswith("-") else F.col(c).asc_nulls_last() for c in columns]
    )


for _report in (
    all_stats_for_deployment, msgs_played_each_tb, package_stats, tb_count_community_package,
    contents_by_deployment, contents_by_package, top_msgs_by_deployment, top_msgs_by_package,
):
    mart(_report)
