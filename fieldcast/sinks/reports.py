"""Writing reports and properties."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcast.functions.text import properties_map
from fieldcast.plans.serials import tbnewsn_past_six_months
from fieldcast.session import scratch_path
from fieldcast.tables import Tables

# Reports written per project and for all projects.
PROJECT_REPORTS = [
    "program_info", "tbnewsn_past_six_months", "deployments", "recipients", "recipients_map", "tbsdeployed",
    "deployments_by_community", "deployments_by_deployment", "deployment_date_mismatch", "tb_deployments",
    "tb_deployments_by_deployment", "production_by_category", "production_by_deployment", "production_by_package",
    "usage_by_deployment", "usage_by_package_category", "usage_by_message", "twbx_info",
]
GLOBAL_REPORTS = ["deployment_dashboard", "usage_dashboard", "tbnewsn_past_six_months"]
#: reports written at a time
WRITERS = 4
RECORD_END = "\r\n\r\n"


def _flat(frame: DataFrame) -> DataFrame:
    """CSV has no structs: a point is written as ``(latitude,longitude)``."""
    points = {
        name: F.when(
            F.col(name).isNotNull(), F.concat(F.lit("("), F.col(f"{name}.latitude"), F.lit(","), F.col(f"{name}.longitude"), F.lit(")"))
        )
        for name, dtype in frame.dtypes
        if dtype.startswith("struct<latitude")
    }
    return frame.withColumns(points) if points else frame


def _side_by_side(write: Callable, calls: Iterable[tuple]) -> None:
    """Independent writes, a few at a time: the last tasks of one leave cores for the next.  The first that fails is raised."""
    with ThreadPoolExecutor(WRITERS) as pool:
        inherited = inheritable_thread_target(SparkSession.active())(write)
        for done in [pool.submit(inherited, *call) for call in calls]:
            done.result()


def write_csv(frame: DataFrame, path: str, order: list[str] | None = None) -> None:
    """CSV with a header; sorted by ``order`` if given (a range sort, part files in sequence)."""
    flat = _flat(frame)
    (flat.orderBy(*order) if order else flat).write.mode("overwrite").option("header", True).csv(path)


def write_project_reports(reports: Mapping[str, DataFrame], path: str, active: DataFrame | None = None) -> None:
    """One pass per report: ``<path>/<report>/project_dir=<p>/part-*.csv`` for every project, or those in ``active`` (column project).

    Rows are gathered by project before writing, which keeps the files few; AQE splits a
    project that is too large for one task.
    """

    def write(name: str, frame: DataFrame) -> None:
        wanted = frame if active is None else frame.join(active.select("project").distinct(), "project", "left_semi")
        flat = _flat(wanted).withColumn("__project", F.col("project"))
        (
            flat.hint("rebalance", "__project")
            .withColumnRenamed("__project", "project_dir")
            .write.mode("overwrite")
            .partitionBy("project_dir")
            .option("header", True)
            .csv(f"{path}/{name}")
        )

    _side_by_side(write, reports.items())


def write_global_reports(reports: Mapping[str, DataFrame], path: str) -> None:
    _side_by_side(lambda name, frame: write_csv(frame, f"{path}/{name}"), reports.items())


def project_report_set(t: Tables, **made: DataFrame) -> dict[str, DataFrame]:
    """The per-project reports; ``made`` supplies those that need a parameter.  A report that is neither made nor known is an error."""
    absent = [name for name in PROJECT_REPORTS if name not in made and name not in t]
    if absent:
        raise KeyError(f"reports to be supplied: {', '.join(absent)}")
    return {name: made[name] if name in made else t[name] for name in PROJECT_REPORTS}


#: results that several reports are made from, each stored once in a run
SHARED = ["deployment_info", "production_info", "usage_info"]
#: and short ones that are made from these or from the plays, and that several reports need
SHARED_SUMMARIES = ["package_tbs_used", "deployments_by_deployment", "usage_by_deployment"]


def write_report_run(spark: SparkSession, t: Tables, path: str, as_of, **made: DataFrame) -> None:
    """A whole run: the results that reports share are stored once, then all reports of the active projects are written below
    ``<path>/project`` and those for all projects below ``<path>/global``."""
    for names in (SHARED, SHARED_SUMMARIES):
        paths = {name: scratch_path(spark, f"shared-{name}") for name in names if not t.stored(name)}
        _side_by_side(lambda frame, stored: frame.write.parquet(stored), [(t[name], stored) for name, stored in paths.items()])
        for name, stored in paths.items():
            t = t.with_table(name, spark.read.parquet(stored))
    made = {"tbnewsn_past_six_months": tbnewsn_past_six_months(t, as_of), **made}
    write_project_reports(project_report_set(t, **made), f"{path}/project", t["project_list"])
    write_global_reports({name: made[name] if name in made else t[name] for name in GLOBAL_REPORTS}, f"{path}/global")


def properties_text(props: str = "props", header: str | None = None):
    """Sorted ``k=v`` lines with CRLF ends, header comments first."""
    lines = F.transform(F.array_sort(F.map_entries(props)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    if header is not None:
        lines = F.concat(F.coalesce(F.col(header), F.array().cast("array<string>")), lines)
    return F.array_join(lines, "\r\n")


def write_properties(records: DataFrame, path: str, header: str | None = None) -> None:
    """Properties records below ``program=/deployment=`` folders, many to a file, a blank line after each.

    One file per message would be millions of tiny files; :func:`read_property_records` reads them back.
    """
    data = F.col("props")
    (
        records.select(
            F.try_element_at(data, F.lit("PROJECT")).alias("program"),
            F.try_element_at(data, F.lit("DEPLOYMENT_NUMBER")).alias("deployment"),
            properties_text("props", header).alias("value"),
        )
        .hint("rebalance", "program", "deployment")
        .write.mode("overwrite")
        .partitionBy("program", "deployment")
        .option("lineSep", RECORD_END)
        .text(path)
    )


def read_property_records(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`write_properties` wrote: program, deployment, ``path`` (of the file), ``header`` comments and ``props``."""
    records = spark.read.option("lineSep", RECORD_END).text(path)
    comments = F.filter(F.split("value", "\r\n"), lambda line: line.startswith("#"))
    return records.select(
        "program", F.col("deployment").cast("bigint").alias("deployment"), F.col("_metadata.file_path").alias("path"),
        comments.alias("header"), properties_map(F.col("value")).alias("props"),
    )


def export_recipients_map(recipients_map: DataFrame) -> DataFrame:
    return recipients_map.select("project", "directory", "recipientid")
