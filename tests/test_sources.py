"""Sources over real files."""

import io
import struct
import time
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldcast.functions import text
from fieldcast.operators import lookup
from fieldcast.plans import feedback
from fieldcast.sinks import reports
from fieldcast.sources import a18, deployed, files, kv

AA = """t1,op1,one:1,two:2,three:3,flag1
t2,op2,two:2,four:4,one:1,flag2

short,line
t3,op1,url:http://x,two:,two:5
"""
BB = """t4,op1,eleven:11,two:2,flag1
t5,op2,three:3,eleven:11
"""


@pytest.fixture
def logs(tmp_path):
    for name, content in (("aa.kvp", AA), ("bb.kvp", BB)):
        (tmp_path / name).write_text(content)
    return str(tmp_path / "aa.kvp"), str(tmp_path / "bb.kvp")


def test_columns_come_in_first_seen_order(spark, logs):
    aa, bb = logs
    first = ["one", "two", "three", "flag1", "four", "flag2", "url"]
    assert kv.discovered_names(kv.read_kv_log(spark, [aa, bb])) == [*first, "eleven"]
    assert kv.discovered_names(kv.read_kv_log(spark, [bb, aa])) == ["eleven", "two", "flag1", "three", "one", "four", "flag2", "url"]


def test_values_defaults_and_repeats(spark, logs):
    table = kv.project_columns(kv.read_kv_log(spark, list(logs)))
    assert table.columns[:3] == ["timestamp", "operation", "one"]
    found = {r["timestamp"]: r for r in table.collect()}
    assert sorted(found) == ["t1", "t2", "t3", "t4", "t5"]
    assert found["t1"]["flag1"] == "True" and found["t2"]["flag1"] == ""
    assert found["t3"]["url"] == "http://x" and found["t3"]["two"] == "5"


def test_column_lists(spark, logs, tmp_path):
    listing = tmp_path / "columns.txt"
    listing.write_text("# comment\nthree\ntimestamp\n")
    names = kv.expand_columns(spark, [f"@{listing}", "two"])
    assert names == ["three", "timestamp", "two"]
    assert kv.project_columns(kv.read_kv_log(spark, [logs[0]]), names).columns == names


def test_garbage_keys_stay_in_the_long_form(spark):
    lines = spark.range(20_000).select(
        F.lit(0).alias("file_no"), F.lit(0).alias("block"), F.col("id").alias("line"),
        F.concat(F.lit("t,op,two:2,k"), "id", F.lit(":"), "id", F.lit(",one:1")).alias("value"),
    )
    parsed = kv.parse_kv(lines)
    assert kv.discovered_names(parsed, most=2) == ["two", "one"]
    wide = kv.project_columns(parsed, ["+"], most=2)
    assert wide.columns == ["two", "one", "other"]
    assert wide.where("two = '2' and one = '1' and size(other) = 1").count() == 20_000
    rest = kv.other_pairs(parsed, ["timestamp", "operation", "two", "one"], ["line"])
    assert rest.where("key = concat('k', line) and value = cast(line as string)").count() == 20_000 == rest.count()


def test_a_list_of_too_many_columns_is_an_error(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(kv, "MOST_COLUMNS", 3)
    (tmp_path / "names").write_text("a\nb\n# c\nd\ne\n")
    with pytest.raises(ValueError):
        kv.expand_columns(spark, [f"@{tmp_path / 'names'}"])


def test_recipients_are_filled_where_the_key_is_absent(spark, tmp_path):
    (tmp_path / "r.kvp").write_text(
        "t0,op,project:proj1,community:some directory name,value:lookup\n"
        "t1,op,project:PROJ2,community:\"Other Directory\",value:quoted\n"
        "t2,op,project:proj3,community:different,value:missing\n"
        "t3,op,project:proj4,community:random,recipientid:c5678,value:provided\n"
        "t4,op,project:proj1,community:some directory name,recipientid:,value:empty\n"
        "t5,op,project:care,community:kpatua no,value:override\n"
    )
    (tmp_path / "map.csv").write_text(
        'recipientid,project,directory\nold,proj1,SOME directory name\na1234,proj1,"some directory name"\n'
        "b3456,proj2,other directory\nd1,CARE,Kpatua No 1\n"
    )
    recipients = files.read_recipients_map(spark, str(tmp_path / "map.csv"))
    filled = lookup.fill_recipient(kv.read_kv_log(spark, [str(tmp_path / "r.kvp")]), recipients)
    found = {r["timestamp"]: r["recipientid"] for r in kv.project_columns(filled, ["timestamp", "recipientid"]).collect()}
    assert found == {"t0": "a1234", "t1": "b3456", "t2": "", "t3": "c5678", "t4": "", "t5": "d1"}


def test_lookup_warnings(spark):
    recipients = spark.createDataFrame([("CARE", "KPATUA NO 1", "d1")], "project string, directory string, recipientid string")
    asked = spark.createDataFrame([("care", "kpatua no"), ("care", "nowhere"), ("care", "nowhere"), ("x", "a"), ("x", "b")], "p string, d string")
    looked_up = lookup.lookup_recipient(asked, recipients, F.col("p"), F.col("d"))
    found = sorted((r["project"], r["directory"] or "", r["reason"], r["lines"]) for r in lookup.lookup_warnings(looked_up, recipients).collect())
    assert found == [("CARE", "KPATUA NO", "override used", 1), ("CARE", "NOWHERE", "unknown directory", 2), ("X", "", "unknown project", 2)]


LINE = "t,deployment,action:update,tbcdid:0001,username:{user},project:P,deployment:D,package:K,community:{community},sn:S{n},firmware:f,location:L,timestamp:20170927T100005.486Z{more}"


def test_deployment_log(spark, rows):
    lines = [
        LINE.format(user="u", community="here", n=1, more=",coordinates:1.5 -2,newsn:t"),
        LINE.format(user="", community="HERE", n=2, more=""),
        LINE.format(user="u", community="Non-Specific", n=3, more=""),
        LINE.format(user="u", community="nowhere", n=4, more=""),
        LINE.format(user="u", community="nowhere", n=5, more=",recipientid:given"),
        LINE.format(user="u", community="here", n=6, more="").replace(",firmware:f", ""),
    ]
    recipients = spark.createDataFrame([("P", "HERE", "r1")], "project string, directory string, recipientid string")
    parsed = kv.parse_kv(spark.createDataFrame([(x,) for x in lines], "value string"))
    found = {r["talkingbookid"]: r for r in deployed.deployments_from_log(parsed, recipients).collect()}
    assert sorted(found) == ["S1", "S2", "S5"]
    assert tuple(found["S1"]["coordinates"]) == (1.5, -2.0) and found["S1"]["newsn"] is True
    assert found["S2"]["username"] == "UNKNOWN" and found["S2"]["coordinates"] is None
    assert found["S5"]["recipientid"] == "given" and str(found["S5"]["deployedtimestamp"]) == "2017-09-27 10:00:05.486000"
    assert rows(deployed.count_non_specific(deployed.log_fields(parsed))) == [("P", 1)]


def test_csv_columns_match_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text('b,a\n2,"x,y"\n,z\n')
    found = files.read_csv(spark, str(tmp_path / "x.csv"), "a string, b int").collect()
    assert sorted((r["a"], r["b"]) for r in found if r["b"]) == [("x,y", 2)] and len(found) == 2


def test_properties(spark, tmp_path):
    folder = tmp_path / "deep" / "er"
    folder.mkdir(parents=True)
    (folder / "m.properties").write_text("#head\r\na=1=2\r\n\r\nnone\r\nb =x\r\na=3\r\n")
    (folder / "m.txt").write_text("a=9")
    (row,) = files.read_properties(spark, str(tmp_path)).collect()
    assert row["props"] == {"a": "3", "b": "x"} and row["path"].endswith("m.properties")


def audio_file(fields, version=1, seconds_bytes=4000, rate=16000):
    body = b"".join(struct.pack("<hi", number, len(data)) + data for number, data in fields)
    audio = struct.pack("<h", rate) + bytes(seconds_bytes - 2)
    return struct.pack("<i", len(audio)) + audio + struct.pack("<ii", version, len(fields)) + body


def text_field(number, *values):
    return number, struct.pack("<b", len(values)) + b"".join(struct.pack("<h", len(v)) + v for v in values)


def test_audio_metadata(spark, tmp_path):
    good = audio_file([text_field(1, b"one", "zwö".encode()), (77, b"\1\2\3"), (33, struct.pack("<bi", 1, -7)), text_field(5, b"TB\xff1")])
    (tmp_path / "a.a18").write_bytes(good)
    (tmp_path / "b.A18").write_bytes(audio_file([], version=2))
    (tmp_path / "c.a18").write_bytes(good[:-3])
    (tmp_path / "d.a18").write_bytes(b"\xff\xff\xff\xff")
    (tmp_path / "e.mp3").write_bytes(b"no")
    found = {r["path"][-5:]: r for r in a18.read_a18(spark, str(tmp_path)).collect()}
    assert found["a.a18"]["md"] == {"TITLE": "one;zwö", "STATUS": "-7", "PUBLISHER": "TB1", "DURATION": "00:02 l", "SECONDS": "2"}
    assert "version 2" in found["b.A18"]["error"]
    assert found["c.a18"]["error"] and found["d.a18"]["error"] and len(found) == 4


def test_zip_artifacts_prefer_loose_files(spark, tmp_path, rows):
    for name in ("x", "y"):
        (tmp_path / name).mkdir()
        with zipfile.ZipFile(tmp_path / name / "tbcd0001.zip", "w") as archive:
            archive.writestr("in/tbsdeployed.csv", "h\n1\n")
            archive.writestr("in/other.csv", "no\n")
    (tmp_path / "y" / "tbsdeployed.csv").write_text("loose\n")
    found = files.read_zip_artifacts(spark, str(tmp_path)).collect()
    assert sorted((r["directory"][-1], r["member"], r["line_no"], r["line"]) for r in found) == [
        ("x", "tbsdeployed.csv", 0, "h"), ("x", "tbsdeployed.csv", 1, "1"), ("y", "tbsdeployed.csv", 0, "loose")]


def test_zip_lines_come_back_many_at_a_time(monkeypatch):
    def archive(lines):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as whole:
            whole.writestr("in/tbsdeployed.csv", lines)
        return out.getvalue()

    batches = [pd.DataFrame({"path": ["a", "bad", "c"], "content": [archive("h\n1\n"), b"no zip", archive("h\n")]}), pd.DataFrame({"path": ["d"], "content": [archive("")]})]
    frames = list(files._zip_members(iter(batches)))
    assert len(frames) == 1
    assert [tuple(r)[:3] for r in frames[0].itertuples(index=False)] == [
        ("a", "tbsdeployed.csv", 0), ("a", "tbsdeployed.csv", 1), ("bad", None, -1), ("c", "tbsdeployed.csv", 0)]
    monkeypatch.setattr(files, "LINES_PER_FRAME", 3)
    assert [len(frame) for frame in files._zip_members(iter(batches))] == [3, 1]


def test_daily_directories_skip_and_limit(spark):
    paths = [(f"p/2021/0{m}/0{d}/2021y0{m}m0{d}d01h02m03s/tbcd{n}.zip",) for m in (1, 2) for d in (1, 2) for n in (1, 2)]
    frame = spark.createDataFrame([*paths, ("p/2021/03/01/2021y03m01d01h02m03s/x.log",)], "path string")
    assert files.daily_directories(frame).count() == 4
    assert files.daily_directories(frame, month="02").count() == 2
    (row,) = files.daily_directories(frame, skip=1, limit=1).collect()
    assert (row["month"], row["day"], str(row["collected"])) == ("01", "02", "2021-01-02 01:02:03")
    with pytest.raises(ValueError):
        files.daily_directories(frame, day="01")


def test_file_walk(spark, tmp_path):
    (tmp_path / "s").mkdir()
    for name in ("a.A18", "b.a18", "c.txt", "s/d.a18"):
        (tmp_path / name).write_text("x")
    listed = files.list_files(spark, str(tmp_path))
    assert tuple(files.walk_counts(listed, ".a18").first()) == (2, 3, 1)
    assert [r["path"][-5:] for r in files.accepted_files(listed, ".a18", limit=2).collect()] == ["a.A18", "b.a18"]


def test_listing(spark):
    frame = spark.createDataFrame([("2021-06-01 12:11:38  77553 collected/C/1/0-ab.mp3",), ("2021-06-01 12:11:38 9 collected/C/1/0-ab.properties",)], "value string")
    assert [tuple(r) for r in files.parse_listing(frame).collect()] == [("0-ab", "collected/C/1/0-ab")]


def test_block_list(spark):
    data = spark.createDataFrame([("tbcd0000",), ("TBCD000C",), ("tbcd0001",)], "tbcdid string")
    lines = spark.createDataFrame([("# skip",), ("tbcd0000 # x",), ("tbcd000c",)], "value string")
    assert [r[0] for r in files.drop_listed_devices(data, lines).collect()] == ["tbcd0001"]


def test_extract_and_properties_round_trip(spark, tmp_path):
    audio = spark.createDataFrame([("/u/c/m1.a18", audio_file([text_field(1, b"t")])), ("/u/c/m2.a18", audio_file([])), ("/u/c/m3.a18", b"")], "path string, content binary")
    sidecars = spark.createDataFrame([("/u/c/m1.properties", {"PROJECT": "P", "DEPLOYMENT": "D", "RECIPIENTID": "r1", "metadata.DATE_RECORDED": "bad"})], "path string, props map<string,string>")
    people = spark.createDataFrame([tuple(["r1", "P"] + ["v"] * 10)], ", ".join(f"{c} string" for c in lookup.RECIPIENT_INFO))
    numbers = spark.createDataFrame([("P", "D", 4), ("P", "D", 3)], "project string, deployment string, deploymentnumber int")
    records, errors = feedback.uf_extract(a18.a18_metadata(audio), sidecars, people, numbers)
    assert sorted((r["path"][-6:], r["error"] == "no sidecar") for r in errors.collect()) == [("m2.a18", True), ("m3.a18", False)]
    (row,) = feedback.uf_map_columns(records).collect()
    assert (row["programid"], row["deploymentnumber"], row["date_recorded"], row["bundle_uuid"]) == ("P", "3", "180102", None)
    reports.write_properties(records, str(tmp_path / "props"))
    (back,) = spark.read.option("lineSep", reports.RECORD_END).text(str(tmp_path / "props")).collect()
    lines = back["value"].split("\r\n")
    assert lines == sorted(lines) and "metadata.filename=m1" in lines and back["program"] == "P"


def test_csv_files_with_columns_in_another_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\none,1\n")
    (tmp_path / "b.csv").write_text("y,x\n2,two\n")
    (tmp_path / "c.csv").write_text("x,y\n\"three, and\",3\n")
    found = files.read_csv(spark, str(tmp_path), "x string, y int")
    assert sorted(map(tuple, found.collect())) == [("one", 1), ("three, and", 3), ("two", 2)]


def test_recipients_maps_with_columns_in_another_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("project,directory,recipientid\np,d,r1\np,e,r2\n")
    (tmp_path / "b.csv").write_text("recipientid,project,directory\nr3,P,D\n")
    found = files.read_recipients_map(spark, str(tmp_path)).collect()
    assert sorted((r["project"], r["directory"], r["recipientid"]) for r in found) == [("P", "D", "r3"), ("P", "E", "r2")]


def test_last_wins_works_out_its_array_once(spark):
    pairs = "transform(sequence(1, 3000), i -> named_struct('key', concat('k', i), 'value', string(i + id)))"
    lines = spark.range(100).selectExpr("id", f"{pairs} AS pairs")
    begin = time.time()
    row = lines.select(text.last_wins(F.col("pairs")).alias("m")).agg(F.sum(F.size("m")).alias("n"), F.max(F.expr("m['k3000']")).alias("v")).first()
    assert (row["n"], row["v"]) == (300_000, "3099")
    assert time.time() - begin < 20  # the cube of a line's pairs took minutes
    rows = [(1, [("a", "1"), (None, "2"), ("a", "3"), ("b", "4")]), (2, None)]
    odd = spark.createDataFrame(rows, "i int, pairs array<struct<key:string,value:string>>")
    assert [r[0] for r in odd.orderBy("i").select(text.last_wins(F.col("pairs"))).collect()] == [{"a": "3", "b": "4"}, None]
