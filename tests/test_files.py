from __future__ import annotations

import csv
import glob
import os

import pytest
from pyspark.sql import functions as F

from airscan.operators.normalize import coerce_numbers
from airscan.plans.survey import SurveyJob
from airscan.schema import LOG_PREHEADER
from airscan.sources import publish, sinks, survey_csv
from airscan.sources.local import added
from airscan.sources.survey_csv import read_logs

META = "free-form,metadata,line\n"
HEADER = "MAC,SSID,Type,RSSI\n"


def write(root, name, content):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())


@pytest.fixture
def logs(tmp_path):
    root = tmp_path / "logs"
    write(root, "jan/ok_a.csv", META + HEADER + "a1,home,WIFI,-50\na2,cafe,BLE,-60\n")
    write(root, "feb/ok_b.csv", META + "Type,Extra,MAC\nWIFI,x,b1\n")
    write(root, "feb/no_preheader.csv", HEADER + "c1,net,WIFI,-1\n")
    write(root, "feb/no_type.csv", META + "MAC,SSID\nd1,net\n")
    write(root, "empty.csv", "")
    write(root, "short_row.csv", META + HEADER + "e1,net\n")
    write(root, "long_row.csv", META + HEADER + 'f1,net,WIFI,-1\nf2,net,WIFI,-2,surplus\nf3,"a,b,c,d",WIFI,-3\nf4,n,WIFI,-4,\n')
    write(root, "bad_utf8.csv", META.encode() + HEADER.encode() + b"g1,caf\xff\xfe,WIFI,-1\n")
    write(root, "quoted.csv", META + HEADER + 'h1,"say ""hi"", ok\\n",WIFI,-1\n')
    write(root, "na_tokens.csv", META + HEADER + "i1,NA,WIFI,-1\ni2,null,WIFI,-1\n")
    write(root, "X.CSV", META + HEADER + "j1,net,WIFI,-1\n")
    return root


def by_mac(frame):
    return {row.MAC: row for row in frame.collect()}


def test_merge_and_rejects(spark, logs):
    found = read_logs(spark, str(logs))
    rows = by_mac(found.rows)
    assert set(rows) == {"a1", "a2", "b1", "e1", "f1", "f3", "g1", "h1", "i1", "i2"}
    assert rows["b1"].Extra == "x" and rows["b1"].SSID is None and rows["a1"].Extra is None
    assert rows["e1"].SSID == "net" and rows["e1"].Type is None
    assert rows["g1"].SSID == "caf��"
    assert rows["h1"].SSID == 'say "hi", ok\\n'
    assert rows["f3"].SSID == "a,b,c,d"
    assert rows["i1"].SSID == "NA" and rows["i2"].SSID == "null"
    assert rows["a1"]._file.endswith("jan/ok_a.csv")
    rejected = {os.path.basename(r.path): r.reason for r in found.rejected_files.collect()}
    assert rejected == {"no_preheader.csv": "bad headers", "no_type.csv": "bad headers", "empty.csv": "error: no header line"}
    assert sorted(r.row for r in found.rejected_rows.collect()) == ["f2,net,WIFI,-2,surplus", "f4,n,WIFI,-4,"]


def test_strict_files_reject_the_whole_file(spark, logs):
    found = read_logs(spark, str(logs), strict_files=True)
    assert not {"f1", "f3"} & set(by_mac(found.rows))
    assert any(r.path.endswith("long_row.csv") for r in found.rejected_files.collect())


def test_strict_encoding_rejects_the_file(spark, logs):
    found = read_logs(spark, str(logs), strict_encoding=True)
    assert "g1" not in by_mac(found.rows)
    assert [r.path.rsplit("/", 1)[1] for r in found.rejected_files.filter("reason LIKE '%UTF-8'").collect()] == ["bad_utf8.csv"]


def test_na_tokens(spark, logs):
    rows = by_mac(read_logs(spark, str(logs), na_tokens=("NA", "null")).rows)
    assert rows["i1"].SSID is None and rows["i2"].SSID is None and rows["a1"].SSID == "home"


def test_line_breaks_inside_quotes(spark, tmp_path):
    write(tmp_path, "a.csv", META + HEADER + 'a1,"two\nlines",WIFI,-1\na2,b,WIFI,-2\n')
    rows = by_mac(read_logs(spark, str(tmp_path), multiline=True).rows)
    assert rows["a1"].SSID == "two\nlines" and rows["a2"].RSSI == "-2"


def test_single_file_of_any_name_and_one_header_folder(spark, tmp_path):
    write(tmp_path, "in/one.log", META + HEADER + "a1,n,WIFI,-1\n")
    write(tmp_path, "in/x/one [1].csv", META + HEADER + "a2,n,WIFI,-1\n")
    write(tmp_path, "in/y/two.csv", META + HEADER + "a3,n,WIFI,-1\n")
    assert set(by_mac(read_logs(spark, str(tmp_path / "in/one.log")).rows)) == {"a1"}
    assert set(by_mac(read_logs(spark, str(tmp_path / "in/x/one [1].csv".replace("[", "\\[").replace("]", "\\]"))).rows)) == {"a2"}
    assert set(by_mac(read_logs(spark, str(tmp_path / "in")).rows)) == {"a2", "a3"}


def test_blank_lines_and_repeated_names(spark, tmp_path):
    write(tmp_path, "a.csv", META + "\nMAC,Type,x,x\n\nm,WIFI,1,2\n")
    row = read_logs(spark, str(tmp_path)).rows.first()
    assert (row.MAC, row["x"], row["x.1"]) == ("m", "1", "2")


def test_no_input(spark, tmp_path):
    write(tmp_path, "a.txt", "x")
    with pytest.raises(ValueError, match="no .csv files"):
        read_logs(spark, str(tmp_path))
    write(tmp_path, "b.csv", "x\ny\n")
    with pytest.raises(ValueError, match="no valid logs"):
        read_logs(spark, str(tmp_path))


SURVEY = "MAC,SSID,Type,RSSI,Channel,CurrentLatitude,CurrentLongitude\n"


@pytest.fixture
def survey(tmp_path):
    lines = []
    for i in range(60):
        lines.append(f'm{i},"net, {i}",WIFI,{-30 - i},{(1, 36, 149)[i % 3]},41.82,-71.41\n')
        lines.append(f"m{i},weak,wifi ,-99,6,48.85,2.35\n")
    lines += ["p1,paris,BLE,-40,,48.85,2.35\n", "q1,,GSM,,,,\n", "r1,none,NFC,-1,1,48.85,2.35\n", "o1,sea,LTE,-7,1,0,0\n"]
    write(tmp_path, "in/a.csv", META + SURVEY + "".join(lines[:70]))
    write(tmp_path, "in/b.csv", META + SURVEY + "".join(lines[70:]))
    return tmp_path


def test_survey_job_outputs(spark, survey):
    out = survey / "out"
    result = SurveyJob(str(survey / "in"), str(out), export=True, rows_per_export=16).run(spark)
    master = spark.read.parquet(str(out / "master"))
    assert master.count() == 63 and not {"country", "state", "_file"} & set(master.columns)
    assert spark.read.parquet(str(out / "no_gps")).count() == 1
    countries = {r.country: r["count"] for r in spark.read.parquet(str(out / "countries")).groupBy("country").count().collect()}
    assert countries == {"usa": 60, "france": 1, "other": 1}
    assert spark.read.parquet(str(out / "us_states")).select("state").distinct().collect()[0].state == "rhode_island"
    bands = spark.read.option("header", True).csv(str(out / "channel_summaries/bands"))
    assert {(r.level, r.region, r.band, r["count"]) for r in bands.collect()} == {
        (level, name, band, n) for level, name in (("country", "usa"), ("us_state", "rhode_island"))
        for band, n in (("2.4GHz", "20"), ("5GHz", "40"))}
    assert {r.stage: r.n for r in result["stages"].collect()} == {
        "rows_read": 124, "after_type_filter": 123, "after_dedup": 63, "geolocated": 62, "no_gps": 1, "files_used": 2}
    assert [r.country for r in result["top_countries"].collect()] == ["usa", "france", "other"]
    assert {r.Type: r["count"] for r in result["types"].collect()} == {"WIFI": 60, "BLE": 1, "GSM": 1, "LTE": 1}
    assert result["us_states"].first()["count"] == 60
    check_exports(spark, out)


def check_exports(spark, out):
    files = glob.glob(str(out / "logs/countries/country=usa/*/*.csv"))
    assert len(files) == 4
    seen = 0
    for path in files:
        with open(path, newline="") as source:
            lines = list(csv.reader(source))
        assert ",".join(lines[0]) == LOG_PREHEADER and lines[1][0] == "MAC"
        strengths = [float(line[3]) for line in lines[2:]]
        assert strengths == sorted(strengths, reverse=True) and len(strengths) < 40
        seen += len(strengths)
    assert seen == 60
    back = read_logs(spark, str(out / "logs/countries")).rows
    want = spark.read.parquet(str(out / "countries")).select("MAC", "SSID", "RSSI").collect()
    got = coerce_numbers(back, ["RSSI"]).select("MAC", "SSID", "RSSI").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_v1_regions_and_options(spark, survey):
    out = survey / "v1"
    result = SurveyJob(str(survey / "in"), str(out), types="WIFI,GSM", level="region").run(spark)
    assert {r.region: r["count"] for r in result["regions"].collect()} == {"us": 60}
    assert sorted(os.listdir(out / "regions"))[-1] == "region=us"
    out = survey / "quick"
    SurveyJob(str(survey / "in"), str(out), types="BLE", channel_summaries=False).run(spark)
    assert not (out / "channel_summaries").exists() and not (out / "no_gps").exists()


def test_export_keeps_line_breaks_nulls_and_quotes(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", 'x "y", z', None), ("b", "two\nlines", "WIFI"), ("c", " padded ", "WIFI")], "MAC string, SSID string, Type string")
    sinks.export_logs(rows, str(tmp_path / "out"))
    back = read_logs(spark, str(tmp_path / "out"), multiline=True).rows
    assert {(r.MAC, r.SSID, r.Type) for r in back.collect()} == {tuple(r) for r in rows.collect()}


def test_split_writes_big_values_in_parallel(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = spark.range(200_000).selectExpr("id", "uuid() AS text", "CASE WHEN id % 3 < 2 THEN 'usa' ELSE 'uk' END AS country")
        sinks.write_split(rows.repartition(16), str(tmp_path / "split"), "country")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(str(tmp_path / "split/country=usa/*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "split")).count() == 200_000


def test_headers_of_any_length_and_case(spark, tmp_path):
    names = [f"c{i}" for i in range(9000)]
    write(tmp_path, "in/wide.csv", META + ",".join(["MAC", "Type", *names]) + "\n" + ",".join(["w1", "WIFI", *names]) + "\n")
    write(tmp_path, "in/first_line.csv", "m" * 200_000 + "\n" + HEADER + "f1,n,WIFI,-1\n")
    write(tmp_path, "in/both.csv", META + "mac,MAC,Type,ssid\nx,b1,WIFI,low\n")
    write(tmp_path, "in/one.csv", META + HEADER + "o1,up,WIFI,-1\no2,n,WIFI,-2,surplus\n")
    write(tmp_path, "in/own.csv", META + "MAC,Type,_file,,_corrupt\np1,WIFI,mine,u,v\n")
    write(tmp_path, "in/bad.csv", META + "mac,type\nz,WIFI\n")
    found = read_logs(spark, str(tmp_path / "in"))
    rows = by_mac(found.rows)
    assert set(rows) == {"w1", "f1", "b1", "o1", "p1"}
    assert rows["w1"]["c8999"] == "c8999" and rows["b1"]["mac.1"] == "x"
    assert (rows["b1"].SSID, rows["o1"].SSID) == ("low", "up")
    assert rows["p1"]["_file.1"] == "mine" and rows["p1"]._file.endswith("own.csv") and rows["p1"]["_corrupt.1"] == "v"
    assert [r.path.rsplit("/", 1)[1] for r in found.rejected_files.collect()] == ["bad.csv"]
    assert [r.row for r in found.rejected_rows.collect()] == ["o2,n,WIFI,-2,surplus"]


def test_a_failing_read_fails_the_job(spark, tmp_path):
    write(tmp_path, "in/a.csv", META + HEADER + "a,n,WIFI,-1\n")
    files = survey_csv.list_files(spark, str(tmp_path / "in"))
    lines = survey_csv.read_lines(spark, str(tmp_path / "in"), ".csv")
    (tmp_path / "in/a.csv").rename(tmp_path / "in/a.moved")
    with pytest.raises(Exception, match="(?i)not.?exist"):
        survey_csv.header_census(spark, files, lines)


FIELDS = ["a,b", 'a,"b,c",d', '"say ""hi""",x', ",,", '""', 'a,"",b', '"a"b,c', 'x"y,z', '"' + "long, " * 5000 + '",end', "é,ü 😀", " a , b "]


def test_cut_fields_equal_the_reader(spark, tmp_path):
    """Lines cut by their own width against Spark's reader by position."""
    write(tmp_path, "a.csv", META + HEADER + "".join(f"m{i},{line}\n" for i, line in enumerate(FIELDS)))
    lines = survey_csv.read_lines(spark, str(tmp_path), ".csv").filter("_text LIKE 'm%'")
    cut = {r.f[0]: [*r.f, *[None] * 6][:6] for r in lines.select(survey_csv.fields_of(F.col("_text")).alias("f")).collect()}
    read = survey_csv.read_positions(spark, str(tmp_path), 6, False, ".csv").collect()
    assert cut == {r["_fields"][0]: r["_fields"] for r in read if r["_fields"][0] != "MAC"}


def test_a_wide_log_leaves_other_rows_narrow(spark, tmp_path):
    names = [f"c{i}" for i in range(3000)]
    write(tmp_path, "wide.csv", META + ",".join(["MAC", "Type", *names]) + "\nw,WIFI," + ",".join(names) + "\n")
    write(tmp_path, "narrow.csv", META + HEADER + 'n1,"a,b",WIFI,-1\nn2,x,WIFI,-1,surplus\nn3\n')
    lines = survey_csv.read_lines(spark, str(tmp_path), ".csv")
    files = spark.createDataFrame([(r.uri, 4) for r in lines.select("uri").distinct().collect()], "uri string, _width int")
    sizes = {r.m: r.n for r in survey_csv.read_ragged(lines, files).select(F.col("_fields")[0].alias("m"), F.size("_fields").alias("n")).collect()}
    assert sizes == {"MAC": sizes["MAC"], "w": 3002, "n1": 4, "n2": 5, "n3": 1}
    found = read_logs(spark, str(tmp_path))
    assert "from_csv" not in found.rows._jdf.queryExecution().toString()[:1_000_000]
    rows = by_mac(found.rows)
    assert set(rows) == {"w", "n1", "n3"} and rows["n1"].SSID == "a,b" and rows["n3"].Type is None and rows["w"].c2999 == "c2999"
    assert [r.row for r in found.rejected_rows.collect()] == ["n2,x,WIFI,-1,surplus"]


def test_relative_folder_takes_its_logs_only(spark, tmp_path, monkeypatch):
    """A folder is no file, even where a file below it has the same name at its end."""
    folder = os.path.relpath(tmp_path / "logs", os.getcwd())
    write(tmp_path, "logs/a.csv", META + HEADER + "a,n,WIFI,-1\n")
    write(tmp_path, "logs/sub/old_logs", META + HEADER + "b,n,WIFI,-1\n")
    write(tmp_path, "logs/sub/logs", META + HEADER + "c,n,WIFI,-1\n")
    assert set(by_mac(read_logs(spark, folder).rows)) == {"a"}
    assert set(by_mac(read_logs(spark, f"{folder}/sub/logs").rows)) == {"c"}


def test_strict_encoding_looks_at_bytes(spark, tmp_path):
    write(tmp_path, "in/valid.csv", META + HEADER + "v,caf\ufffd,WIFI,-1\n")
    write(tmp_path, "in/broken.csv", META.encode() + HEADER.encode() + b"b,caf\xe9,WIFI,-1\n")
    write(tmp_path, "in/broken_first_line.csv", b"\xff\n" + HEADER.encode() + b"c,n,WIFI,-1\n")
    found = read_logs(spark, str(tmp_path / "in"), strict_encoding=True)
    assert set(by_mac(found.rows)) == {"v"}
    assert {os.path.basename(r.path) for r in found.rejected_files.collect()} == {"broken.csv", "broken_first_line.csv"}


def test_a_scheme_that_only_spark_opens(spark, logs):
    """The same logs below a mount point of Hadoop's view file system."""
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.logs.link./in", f"file://{logs}")
    near, far = read_logs(spark, str(logs)), read_logs(spark, "viewfs://logs/in")
    assert set(by_mac(far.rows)) == set(by_mac(near.rows))

    def rejects(found):
        return sorted((os.path.basename(r.path), r.reason) for r in found.rejected_files.collect())

    assert rejects(far) == rejects(near)
    assert sorted(r.row for r in far.rejected_rows.collect()) == sorted(r.row for r in near.rejected_rows.collect())


def test_input_columns_named_like_added_ones(spark, tmp_path):
    header = "MAC,Type,RSSI,CurrentLatitude,CurrentLongitude,Region,Country,state\n"
    write(tmp_path, "in/a.csv", META + header + "a,WIFI,-1,41.82,-71.41,r,c,s\n")
    SurveyJob(str(tmp_path / "in"), str(tmp_path / "out"), export=True, channel_summaries=False).run(spark)
    master = spark.read.parquet(str(tmp_path / "out/master")).first()
    assert (master.Region, master.Country, master.state) == ("r", "c", "s") and "_file" not in master
    state = spark.read.parquet(str(tmp_path / "out/us_states")).first()
    assert (state.state, state.state_input, state.Country_input, state.Region) == ("rhode_island", "s", "c", "r")
    back = read_logs(spark, str(tmp_path / "out/logs/countries")).rows.first()
    assert (back.Country_input, back.Region) == ("c", "r")


def test_export_folders_of_null_and_none(spark, tmp_path):
    rows = spark.createDataFrame([("a", "WIFI", None), ("b", "WIFI", "none")], "MAC string, Type string, kind string")
    sinks.export_logs(rows, str(tmp_path / "out"), "kind")
    assert sorted(p for p in os.listdir(tmp_path / "out") if "=" in p) == ["kind=__HIVE_DEFAULT_PARTITION__", "kind=none"]


def test_one_row_repeated_many_times_is_many_logs(spark, tmp_path):
    rows = spark.range(4000).selectExpr("'a' AS MAC", "'WIFI' AS Type")
    sinks.export_logs(rows, str(tmp_path / "out"), rows_per_file=500)
    sizes = [sum(1 for _ in open(p)) - 2 for p in glob.glob(str(tmp_path / "out/*/*/*.csv"))]
    assert len(sizes) == 8 and sum(sizes) == 4000 and max(sizes) < 700


def test_rows_in_another_order_each_time_are_all_exported_once(spark, tmp_path):
    rows = spark.range(3000).selectExpr("concat('m', id) AS MAC", "'WIFI' AS Type").orderBy(F.rand())
    sinks.export_logs(rows, str(tmp_path / "out"), rows_per_file=500)
    macs = [r.MAC for r in read_logs(spark, str(tmp_path / "out")).rows.collect()]
    assert sorted(macs) == sorted(f"m{i}" for i in range(3000))


def test_a_died_run_stays_unseen_and_is_resumed(spark, survey, monkeypatch):
    """Between two parts of a second run readers still find the first one whole; started again, it keeps its finished parts."""
    out = str(survey / "published")

    def job(run):
        return SurveyJob(str(survey / "in"), out, run_id=run, channel_summaries=False)

    assert publish.current(spark, out) is None
    job("first").run(spark)
    assert publish.current(spark, out) == f"{out}/runs/first"
    with monkeypatch.context() as patch:
        patch.setattr(sinks, "split_states", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            job("second").run(spark)
    here = publish.current(spark, out)
    assert here == f"{out}/runs/first" and spark.read.parquet(f"{here}/us_states").count() == 60
    before = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{out}/runs/second/master/*.parquet")}
    assert before and not os.path.exists(f"{out}/runs/second/us_states")
    result = job("second").run(spark)
    assert publish.current(spark, out) == f"{out}/runs/second"
    assert {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{out}/runs/second/master/*.parquet")} == before
    assert spark.read.parquet(f"{out}/runs/second/us_states").count() == 60 and result["us_states"].first()["count"] == 60
    job("second").run(spark)
    assert len(os.listdir(f"{out}/_manifests")) <= 4  # a file of two runs each, with checksums


def test_each_log_is_sorted_in_a_task_of_its_own(spark, tmp_path):
    rows = spark.range(400).selectExpr("concat('m', id) AS MAC", "'WIFI' AS Type", "nullif(id % 16, 3) AS kind")
    sinks.export_logs(rows, str(tmp_path / "out"), "kind", rows_per_file=20)
    tasks = [os.path.basename(p).split("-")[1] for p in glob.glob(str(tmp_path / "out/*/*/*.csv"))]
    assert len(tasks) == len(set(tasks)) == 32
    assert read_logs(spark, str(tmp_path / "out")).rows.select("MAC").distinct().count() == 400


def test_columns_of_wide_logs_are_plain_nulls_in_other_scans(spark, tmp_path):
    """Files of each class of widths are a scan of their own; names meet without regard to case, order or class."""
    names = [f"c{i}" for i in range(200)]
    write(tmp_path, "in/a.csv", META + "Type,MAC,ssid,path\nWIFI,n1,low,p\nWIFI,n2,,\nType,MAC,ssid,path\nWIFI,n3,x,y,surplus\n")
    write(tmp_path, "in/b.csv", META + HEADER + 'n4,"MAC, Type",WIFI,-1\n')
    write(tmp_path, "in/wide.csv", META + ",".join(["MAC", *names, "SSID", "Type"]) + "\n" + ",".join(["w1", *names, "up", "WIFI"]) + "\n")
    found = read_logs(spark, str(tmp_path / "in"))
    rows = by_mac(found.rows)
    assert set(rows) == {"n1", "n2", "n4", "w1"} and added(found.rows) == ["_file", "_log_id"]
    assert [rows[m].SSID for m in ("n1", "n2", "n4", "w1")] == ["low", None, "MAC, Type", "up"]
    assert (rows["n1"].path, rows["w1"].path, rows["n1"].c0, rows["w1"].c199) == ("p", None, None, "c199")
    assert [r.row for r in found.rejected_rows.collect()] == ["WIFI,n3,x,y,surplus"]
    plan = found.rows.select("c7")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "null AS c7" in plan
