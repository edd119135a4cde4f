"""Rules of the feedback chain and of lookups that the derived tables do not reach."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fieldcast.functions.text import coordinates
from fieldcast.operators.bundling import next_fit
from fieldcast.operators.lookup import RECIPIENT_OVERRIDES, lookup_recipient, lookup_warnings
from fieldcast.plans.feedback import uf_publish_manifest
from fieldcast.sinks import reports
from fieldcast.sources.a18 import _salvage
from fieldcast.tables import Tables


@pytest.mark.parametrize("rows_per_block", [1, 2, 100])
def test_a_missing_size_counts_as_nothing(spark, rows_per_block):
    rows = [("g", k, size) for k, size in enumerate([10, None, 10, 95, 95])]
    frame = spark.createDataFrame(rows, "g string, k long, size long")
    found = {r.k: r.bundle_index for r in next_fit(frame, ["g"], "k", "size", 100, rows_per_block).collect()}
    assert found == {0: 0, 1: 0, 2: 0, 3: 1, 4: 2}


def test_a_bundle_goes_to_one_place(spark):
    rows = [("P", 1, "en", "m1", "b1"), ("P", 1, "fr", "m2", "b1"), ("P", 1, "fr", "m0", "b2")]
    frame = spark.createDataFrame(rows, "programid string, deploymentnumber long, language string, message_uuid string, bundle_uuid string")
    found = {r.message_uuid: r.out_key for r in uf_publish_manifest(frame, "root").collect()}
    assert found == {"m1": "root/deployment-1/en/b1.zip", "m2": "root/deployment-1/en/b1.zip", "m0": "root/deployment-1/fr/b2.zip"}


def test_every_override_is_told_by_its_own_name(spark):
    first, second = RECIPIENT_OVERRIDES["UWR"]
    used = RECIPIENT_OVERRIDES["UWR"][first]
    assert used == RECIPIENT_OVERRIDES["UWR"][second]
    asked = spark.createDataFrame([("uwr", first.lower()), ("UWR", second), ("UWR", second), ("UWR", "elsewhere"), ("none", "x")], "p string, d string")
    known = spark.createDataFrame([("UWR", used, "r1")], "project string, directory string, recipientid string")
    found = lookup_warnings(lookup_recipient(asked, known, F.col("p"), F.col("d")), known).collect()
    assert {(r.project, r.directory, r.reason, r.lines) for r in found} == {
        ("UWR", first, "override used", 1), ("UWR", second, "override used", 2),
        ("UWR", "ELSEWHERE", "unknown directory", 1), ("NONE", None, "unknown project", 1),
    }


def test_properties_are_read_back(spark, tmp_path):
    rows = [({"PROJECT": "P", "DEPLOYMENT_NUMBER": str(k % 2), "x": f"a=b {k}"}, ["# made", f"# {k}"]) for k in range(50)]
    records = spark.createDataFrame(rows, "props map<string,string>, header array<string>")
    reports.write_properties(records, str(tmp_path / "p"), "header")
    back = reports.read_property_records(spark, str(tmp_path / "p")).collect()
    assert sorted((r.program, r.deployment, sorted(r.props.items()), r.header) for r in back) == sorted(
        ("P", int(p["DEPLOYMENT_NUMBER"]), sorted(p.items()), h) for p, h in rows
    )


def test_absent_reports_are_an_error(spark):
    with pytest.raises(KeyError):
        reports.project_report_set(Tables({}), program_info=spark.range(1))


@pytest.mark.parametrize(
    ("text", "pair"),
    [("(1.5, -2)", (1.5, -2)), ("1.5 -2", (1.5, -2)), (" +.5,3. ", (0.5, 3)), ("( 1 , 2 )", (1, 2)), ("1.2.3 4", (None, 4)), (".. 1", (None, 1)), (".. 1.2.3", None), ("1", None), ("1 2 3", None), ("", None)],
)
def test_coordinates(spark, text, pair):
    got = spark.createDataFrame([(text,)], "c string").select(coordinates(F.col("c")).alias("c")).first().c
    assert (got and tuple(got)) == pair


def test_salvaged_text():
    assert _salvage(b"a\xffb\x01c\n") == "abc" and _salvage("é".encode()) == "é"


def test_created_properties(spark):
    from fieldcast.plans.feedback import uf_create_properties

    audio = spark.createDataFrame([("/x/here/a.a18", {"PUBLISHER": "TB1", "TITLE": "t"}, None)], "path string, md map<string,string>, error string")
    sidecars = spark.createDataFrame([], "path string, props map<string,string>")
    directories = spark.createDataFrame([("P", "HERE", "r9", 1), ("P", "HERE", "r1", 2)], "project string, directory string, recipientid string, line int")
    columns = "recipientid project partner affiliate country region district communityname groupname agent language listening_model".split()
    people = spark.createDataFrame([("r1", "P", *[None] * 2, "C", *[None] * 7)], ", ".join(f"{c} string" for c in columns))
    props = uf_create_properties(audio, sidecars, directories, "P", 3, people, ["line"]).first().props
    assert props["RECIPIENTID"] == "r1" and props["recipient.country"] == "C" and props["TALKINGBOOKID"] == "TB1"


def test_a_damaged_zip_gives_an_error_row(spark):
    from fieldcast.sources.files import zip_artifacts

    zips = spark.createDataFrame([("/in/1/tbcd1.zip", bytearray(b"no zip"))], "path string, content binary")
    found = zip_artifacts(zips).collect()
    assert [(r.directory, r.member, r.line_no) for r in found] == [("/in/1", None, -1)] and found[0].line
