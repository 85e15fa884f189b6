import os
from datetime import datetime
from types import SimpleNamespace

import pytest

from flowloom.operators.lists import distinct_values
from flowloom.plans import flows as plan
from flowloom.sources import csvfiles, exports, staging

TRICKY = [
    (1, "plain", 1.5, datetime(2024, 1, 1, 0, 0, 0, 123456)),
    (2, "", None, datetime(2024, 1, 1)),
    (3, None, 0.1, None),
    (4, ' blanks, "quotes" and \\ back\\"slash ', 1e-300, datetime(1999, 12, 31, 23, 59, 59, 999999)),
    (5, "-", float("inf"), datetime(2024, 2, 29)),
]
SCHEMA = "id bigint, text string, x double, ts timestamp_ntz"


def test_csv_keeps_rows(spark, tmp_path):
    rows = spark.createDataFrame(TRICKY, SCHEMA)
    back = csvfiles.csv_roundtrip(rows, str(tmp_path / "out"), 2)
    assert sorted(map(tuple, back.collect())) == TRICKY
    assert len([f for f in os.listdir(tmp_path / "out") if f.endswith(".csv")]) == 2


def test_csv_keeps_line_breaks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "two\nlines", 1.0, None), (2, "three\r\n\nlines", 2.0, None)], SCHEMA)
    back = csvfiles.csv_roundtrip(rows, str(tmp_path / "out"), 1)
    assert rows.exceptAll(back).count() == 0 and back.count() == 2


def test_csv_keeps_odd_texts(spark, tmp_path):
    texts = ["a\nb", "\\N", "\\n", "\\\\N", "\r", "\r\n", "", " ", '"', "\\", "\\b", None, "#x", "a,b", "\u2028\x85", "\n"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    back = csvfiles.csv_roundtrip(rows, str(tmp_path / "out"), 1)
    assert sorted(map(str, [r["text"] for r in back.collect()])) == sorted(map(str, texts))
    assert back.filter("text is null").count() == 1


def test_existing_path_is_an_error(spark, tmp_path):
    rows = spark.range(3)
    csvfiles.write_csv(rows, str(tmp_path / "out"))
    with pytest.raises(Exception, match="already exists"):
        csvfiles.write_csv(rows, str(tmp_path / "out"))


def test_rows_that_do_not_fit_are_an_error(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id\n1\nx\n")
    with pytest.raises(Exception, match="(?i)malformed|cannot parse|failed"):
        csvfiles.read_csv(spark, str(tmp_path / "bad.csv"), "id bigint").collect()


def list_files(folder):
    """Files like the public lists of domains and of service ports, cut short."""
    (folder / "domains.csv").write_text("Rank,Domain,TLD\n1,a.example.com,com\n2,b.example.org,org\n3,a.example.com,com\n")
    ports = ["Service Name,Port Number,Protocol", "x,1,tcp", "http,80,tcp", "http,80,udp", "none,,tcp", "range,90-99,tcp"]
    ports += ["https,443,tcp", *[f"p{n},{n},tcp" for n in range(1000, 1400)]]
    (folder / "ports.csv").write_text("\n".join(ports) + "\n")


def test_lists_from_csv(spark, tmp_path):
    list_files(tmp_path)
    domains = distinct_values(csvfiles.read_text_columns(spark, str(tmp_path / "domains.csv"), "Domain"), "Domain", "host")
    assert sorted(r["host"] for r in domains.collect()) == ["a.example.com", "b.example.org"]
    ports = csvfiles.read_text_columns_in_order(spark, str(tmp_path / "ports.csv"), "Port Number")
    rows = ports.orderBy("pos").collect()
    assert [(r["pos"], r["Port Number"]) for r in rows[:6]] == [(0, "1"), (1, "80"), (2, "80"), (3, None), (4, "90-99"), (5, "443")]


def test_flow_table_from_csv_lists(spark, small, tmp_path):
    list_files(tmp_path)
    events = spark.read.parquet(f"{small}/events.parquet")
    hosts = distinct_values(csvfiles.read_text_columns(spark, str(tmp_path / "domains.csv"), "Domain"), "Domain", "host")
    ports = csvfiles.read_text_columns_in_order(spark, str(tmp_path / "ports.csv"), "Port Number").withColumnRenamed(
        "Port Number", "raw"
    )
    start, end = "23/6/2020 11:00", "23/6/2020 13:00"
    flows = plan.flow_table(events, hosts, ports, start, end, 3000, "secret", fake=3, none=3)
    path = exports.export_flows(flows, str(tmp_path), start, end, files=2)
    assert path.endswith("/flows_2362020_1100_to_2362020_1300.csv")
    back = csvfiles.read_csv(spark, path, flows.schema)
    assert flows.exceptAll(back).count() == 0 and back.exceptAll(flows).count() == 0
    favoured = back.filter("source_port in (80, 443)").count() / back.count()
    assert 0.75 < favoured < 0.85


def test_export_by_window(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, datetime(2024, 1, 11, 5)), (2, datetime(2024, 11, 1, 6)), (3, datetime(2024, 11, 1, 7))], "id int, ts timestamp_ntz"
    )
    manifest = {r["path_label"]: r["n"] for r in exports.export_manifest(rows).collect()}
    assert manifest == {"flows_11012024_0000_to_12012024_0000": 1, "flows_01112024_0000_to_02112024_0000": 2}
    exports.export_windows(rows, str(tmp_path / "out"))
    folders = {f.removeprefix("path_label=") for f in os.listdir(tmp_path / "out") if f.startswith("path_label=")}
    assert folders == set(manifest)


def test_export_keeps_rows_without_a_time(spark, tmp_path):
    schema = "id int, ts timestamp_ntz, text string"
    rows = spark.createDataFrame([(1, datetime(2024, 1, 11, 5), "a"), (2, None, "\\N"), (3, datetime(1969, 12, 31, 23), None)], schema)
    for window, labels in (("1 day", {"flows_11012024_0000_to_12012024_0000", "flows_no_time", "flows_31121969_0000_to_01011970_0000"}),
                           ("90 minutes", {"flows_11012024_0430_to_11012024_0600", "flows_no_time", "flows_31121969_2230_to_01011970_0000"})):
        manifest = {r["path_label"]: r["n"] for r in exports.export_manifest(rows, window=window).collect()}
        assert manifest == dict.fromkeys(labels, 1)
        path = str(tmp_path / window.replace(" ", "_"))
        exports.export_windows(rows, path, window=window)
        back = exports.read_windows(spark, path, rows.schema)
        assert sorted(tuple(r)[:3] for r in back.collect()) == sorted(map(tuple, rows.collect()))
        assert {r["path_label"] for r in back.collect()} == labels


def test_shared_folder(spark, monkeypatch):
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: "hdfs:///shared"), sparkContext=None)
    assert staging.shared_folder(named) == "hdfs:///shared"
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(unset)


def test_a_scope_drops_what_it_staged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path / "shared"))
    before = staging.stage(spark.range(3), "before")
    with staging.staged_scope(spark) as scope:
        inside = staging.stage(spark.range(5), "inside")
        assert inside.count() == 5 and len(scope.paths) == 1
    assert not os.path.exists(scope.paths[0]) and before.count() == 3


def test_a_staged_result_outlives_its_steps(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path / "shared"))
    with staging.staged_scope(spark) as outer:
        result = staging.staged_result(spark, lambda: staging.stage(spark.range(4), "step").filter("id > 0"), "result")
        assert result.count() == 3 and len(os.listdir(tmp_path / "shared" / spark.sparkContext.applicationId)) == 1
    assert not any(os.path.exists(path) for path in outer.paths)


def test_staged_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path / "shared"))
    staged = staging.stage(spark.range(5), "numbers")
    assert staged.count() == 5 and len(os.listdir(tmp_path / "shared")) == 1
    staging.drop_staged(spark)
    assert os.listdir(tmp_path / "shared") == []
    staging.drop_staged(spark)
