"""Time the headline reports and jobs; prints one JSON line.

BENCH_SF_DIR names the test tables, BENCH_CPUS the local cores.  The domain tables are
derived and stored first ("setup"), and so are usage_info and allsources_s, as reports read
stored tables; each query then runs to
a sink that drops its rows, once as a warm-up and once counted.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame

from fieldcast.bindings import stored_tables
from fieldcast.operators import merge
from fieldcast.plans import feedback
from fieldcast.plans.serials import tbnewsn_past_six_months
from fieldcast.queries import AS_OF
from fieldcast.session import build_session, scratch_path
from fieldcast.sources import kv

TABLES = [
    "projects", "recipients", "communities", "deployments", "languages", "packagesindeployment", "tbsdeployed",
    "contentmetadata2", "categories", "contentinpackage", "playstatistics", "syncaggregation", "playedevents",
    "uf_messages", "collected_uuids", "kv_lines",
]
MARTS = [
    "deployment_info", "deployments_by_deployment", "deployments_by_community", "deployment_dashboard",
    "tb_deployments_by_deployment", "tbnewsn_by_months", "production_info", "production_by_deployment",
    "production_by_package", "production_by_category", "usage_info", "package_tbs_used", "twbx_info",
    "usage_by_message", "usage_by_package_category", "usage_by_deployment", "usage_dashboard",
    "logstats_from_played_events", "allsources", "all_stats_for_deployment", "package_stats",
    "top_msgs_by_deployment", "missing_uf_not_in_db",
]


def store(spark, frame: DataFrame) -> DataFrame:
    path = scratch_path(spark, "stored")
    frame.write.parquet(path)
    return spark.read.parquet(path)


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": str(max(8, int(cpus))), "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    begin = time.time()
    source = stored_tables(spark, sf_dir, TABLES)
    t = source.with_table("usage_info", store(spark, source["usage_info"]))
    normal = t.with_table(
        "packagesindeployment", merge.normalize_case(t["packagesindeployment"], "packagesindeployment")
    )
    normal = normal.with_table("allsources_s", store(spark, source["allsources_s"]))
    setup = time.time() - begin

    upper_case = {"all_stats_for_deployment", "package_stats", "top_msgs_by_deployment"}
    chosen = {name: normal if name in upper_case else source if name == "usage_info" else t for name in MARTS}
    jobs = {name: (lambda n=name: run(chosen[n][n])) for name in MARTS}
    plays = t["playstatistics"]
    batch = plays.where("tbcdid >= 'tbcd6'")
    order = ["deployment_uuid", "played_seconds", "completed", "community", "recipientid"]
    jobs["tbnewsn_past_six_months"] = lambda: run(tbnewsn_past_six_months(t, AS_OF))
    jobs["merge_playstatistics"] = lambda: run(merge.merge_playstatistics(plays, batch, order))
    jobs["src_kv_log"] = lambda: run(kv.parse_kv(t["kv_lines"]))
    jobs["uf_bundle"] = lambda: run(feedback.uf_bundle(t["uf_messages"], 1_000_000))
    jobs["uf_bundle_blocks"] = lambda: run(feedback.uf_bundle(t["uf_messages"], 1_000_000, rows_per_block=1000))

    seconds: dict[str, float] = {}
    for name, job in jobs.items():
        job()  # warm-up
        begin = time.time()
        job()
        seconds[name] = round(time.time() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "report_suite_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "setup_seconds": round(setup, 1),
                "cores": int(cpus),
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
