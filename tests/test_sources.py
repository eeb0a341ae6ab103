import json

import pytest

from factloom.sources import exports as ex
from factloom.streaming.ingest import each_batch, file_stream, sessions


def test_keyed_json_both_shapes(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"AN1": [{"PRODUCTNAME": "甲", "MBREVENUE": "1"}, {"PRODUCTNAME": "乙", "INFOCODE": "AN9"}], " ": [{"PRODUCTNAME": "丙"}]}, ensure_ascii=False))
    (tmp_path / "b.json").write_text(json.dumps([{"INFOCODE": "AN2", "PRODUCTNAME": "丁"}], ensure_ascii=False))
    (tmp_path / "c.json").write_text(" ")
    got = sorted((r.INFOCODE or "", r.PRODUCTNAME) for r in ex.read_keyed_json(spark, str(tmp_path)).collect())
    assert got == [("", "丙"), ("AN1", "甲"), ("AN2", "丁"), ("AN9", "乙")]
    for bad in ("17", '{"AN1": 3', "rows"):
        (tmp_path / "c.json").write_text(bad)
        with pytest.raises(Exception, match="neither"):
            ex.read_keyed_json(spark, str(tmp_path)).collect()


def test_grouped_json(spark, tmp_path):
    rows = [("AN1", str(i), "x") for i in range(25)] + [(" AN2 ", None, "y"), (None, "1", "z"), (" ", "2", "z")]
    df = spark.createDataFrame(rows, "INFOCODE string, MBREVENUE string, other string")
    assert ex.write_grouped(df, str(tmp_path / "g"), ["PRODUCTNAME", "MBREVENUE"], most=10) == {"groups": 2, "rows": 26, "skipped": 2}
    back = ex.read_grouped(spark, str(tmp_path / "g")).collect()
    assert sorted((r.INFOCODE, r.MBREVENUE or "") for r in back) == sorted([("AN1", str(i)) for i in range(25)] + [("AN2", "")])
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "g")).collect()]
    assert {k for x in lines for k in x} == {"AN1", "AN2"} and max(len(v) for x in lines for v in x.values()) < 25
    with pytest.raises(ValueError, match="fields"):
        ex.write_grouped(df, str(tmp_path / "h"), [])
    assert ex.write_grouped(df.limit(0), str(tmp_path / "i"), ["MBREVENUE"]) == {"groups": 0, "rows": 0, "skipped": 0}


def test_paths_into_records(spark):
    df = spark.range(1).selectExpr("id", "named_struct('records', array(named_struct('v', 1), named_struct('v', 2)), 'm', map('k', array(3, 4)), 'none', cast(null as array<struct<v:int>>)) AS data")
    get = lambda path: sorted((r.value for r in ex.at_path(df, path).collect()), key=str)
    assert (get("data.records.v"), get("data.m.k"), get("data.none.v"), get("data.m.x")) == ([1, 2], [3, 4], [None], [None])
    assert ex.at_path(df, "data.records").columns == ["id", "data", "value"]


def test_no_machine_local_checkpoints_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from factloom.sources.tables import shared_dir

    made = []
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: made[-1] if made else None, setCheckpointDir=made.append, getConf=lambda: SimpleNamespace(get=lambda *a: None))
    session = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session)
    session.conf = SimpleNamespace(get=lambda *a: "hdfs:///shared")
    assert shared_dir(session) == "hdfs:///shared"


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([("AN1", "x"), ("AN2", "y"), (None, "z"), (" ", "w")], "INFOCODE string, v string")
    ex.write_keyed(df, str(tmp_path / "k"))
    assert sorted(r.v for r in spark.read.json(str(tmp_path / "k")).collect()) == ["x", "y"]
    ex.write_tsv(spark.createDataFrame([("AN1", "c", "s", "1|2", "m", 1, 2)], ex.INVENTORY_SCHEMA), str(tmp_path / "t"))
    assert ex.read_inventory(spark, str(tmp_path / "t")).first().gt_rows == 2


def test_schema(tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"fields": ["STARTDATE", "REPORTDATE", "PRODUCTNAME", "UNIT"], "num_tol": 0.1, "other": 1}))
    s = ex.TaskSchema.load(str(tmp_path / "s.json"))
    assert (s.value_fields, s.num_tol, s.options) == (("UNIT",), 0.1, {"other": 1})
    for bad in ({}, {"fields": ["A"], "match_key_fields": ["B"]}):
        (tmp_path / "s.json").write_text(json.dumps(bad))
        with pytest.raises(ValueError):
            ex.TaskSchema.load(str(tmp_path / "s.json"))


def test_jobs(spark, tmp_path):
    for name, head in (("AN202301010000000001.pdf", b"%PDF-1.7"), ("AN202301010000000002.pdf", b"<html>")):
        (tmp_path / name).write_bytes(head)
    jobs = spark.createDataFrame([(f"AN20230101000000000{i}",) for i in (1, 2, 3, 4)], "infocode string")
    got = {r.infocode[-1]: r.state for r in ex.discover_jobs(jobs, ex.read_files(spark, str(tmp_path)), ["AN202301010000000004"]).collect()}
    assert got == {"1": "ready", "2": "not_pdf", "3": "missing", "4": "excluded"}


def test_page_json(spark, tmp_path):
    blocks = [{"type": "text", "content": "甲", "bbox": [1.5, 2]}, {"type": "page_number", "content": "3"}, {"type": "footer", "content": "x"}, {"type": "footer", "content": "后附第一部分"}, {"type": "table", "content": "<table><tr><td colspan=2>Ａ</td></tr></table>"}, {"type": "text", "content": ""}, {"type": "footer", "content": "隨附部分"}, {"type": "text", "content": "１ 丙"}]
    folder = tmp_path / "handover"
    folder.mkdir()
    (folder / "AN202301010000000001_12.json").write_text(json.dumps(blocks, ensure_ascii=False))
    (folder / "AN202301010000000001_over_1.json").write_text("[]")
    got = [(r.page_number, r.block_no, r.type, r.x0, r.text, r.grid) for r in ex.read_page_json(spark, str(folder)).orderBy("block_no").collect()]
    assert got == [(12, 0, "text", 1.5, "甲", None), (12, 3, "footer", None, "后附第一部分", None), (12, 4, "table", None, "<table><tr><tdcolspan=2>A</td></tr></table>", [["A", "A"]]), (12, 7, "text", None, "1丙", None)]


def test_accept_and_latest(spark):
    kept = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "k string, v string")
    new = spark.createDataFrame([("a", "9"), ("b", " "), (None, "7")], "k string, v string")
    assert sorted(tuple(r) for r in ex.accept_rows(kept, new, "k").collect()) == [("a", "9"), ("b", "3")]
    runs = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", None, "z")], "k string, at int, v string")
    assert sorted((r.k, r.v) for r in ex.latest_runs(runs, "k", "at").collect()) == [("a", "y"), ("b", "z")]


def test_project_and_report(spark, tmp_path):
    df = spark.createDataFrame([("x",)], "a string")
    assert ex.project(df, ["b", "a"]).first().asDict() == {"b": None, "a": "x"}
    ex.html_report({"recall": 0.5}, [{"field": "<UNIT>", "ok": 1}], str(tmp_path / "r.html"))
    assert "&lt;UNIT&gt;" in (tmp_path / "r.html").read_text()


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(4).write.parquet(str(tmp_path / "in"))
    q = each_batch(file_stream(spark, str(tmp_path / "in"), events.schema, 1), lambda b: b.where("value > 10"), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.where("value > 10").count()
    assert sessions(events).agg({"n_events": "sum"}).first()[0] == events.count()


def test_cache_freshness(spark):
    files = spark.createDataFrame([("a", 1, "t1"), ("b", 2, "t2"), ("c", 3, "t3")], "path string, length int, modificationTime string")
    cache = spark.createDataFrame([("a", 1, "t1", "x"), ("a", 1, "t1", "y"), ("b", 2, "t9", "z"), ("d", 4, "t4", "w")], "path string, length int, modificationTime string, text string")
    fresh, stale = ex.fresh_cache(files, cache)
    assert sorted(r.text for r in fresh.collect()) == ["x", "y"]
    assert sorted(r.path for r in stale.collect()) == ["b", "c"]


def test_command_line(spark, tmp_path, capsys):
    from factloom.__main__ import main

    assert main(["list"]) == 0 and "p5_found" in capsys.readouterr().out
    assert main(["run", "e_event_property", "/root/testdata/sf0.001", "--out", str(tmp_path / "o")]) == 0
    assert spark.read.parquet(str(tmp_path / "o")).count() > 0
    assert main(["report", "/root/testdata/sf0.001", str(tmp_path / "r.html")]) == 0
    assert "recall" in (tmp_path / "r.html").read_text()
    with pytest.raises(SystemExit):
        main(["run", "nothing", "x"])
