from __future__ import annotations

import datetime as dt
import gzip
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from siltwatch.sources import datasets as D
from siltwatch.sources import schemas, sinks

T0 = dt.datetime(2024, 1, 31, 12, tzinfo=dt.timezone.utc)


@pytest.fixture
def base(tmp_path):
    (tmp_path / "360_dga_domain.csv").write_text("Domain,DGA_family,Type\nabc.com,f,t\nabc.com,f,t\nq,f,t\n")
    (tmp_path / "bambenek_dga_domain.csv").write_text("Domain,DGA_family,Type\nx.y.org,f,t\n")
    (tmp_path / "dgarchive").mkdir()
    (tmp_path / "dgarchive" / "conficker_dga.csv").write_text("".join(f"d{i}.net,1,2\n" for i in range(5)))
    (tmp_path / "dgarchive" / "nymaim_x.csv").write_text("n1.net,1,2\n")
    (tmp_path / "textlogs").mkdir()
    (tmp_path / "textlogs" / "a.txt").write_text("2024-01-01T10:00:00.123Z NOERROR 1.2.3.4 10.0.0.1 www.uni.de A 1.1.1.1 120b\n")
    (tmp_path / "textlogs" / "b.txt").write_text("bad NOERROR 1.2.3.4 10.0.0.1 mail.uni.de A 1.1.1.1 120b\n")
    (tmp_path / "users").mkdir()
    (tmp_path / "users" / "one.csv").write_text("query,class\na.b.c,legit\na.b.c,legit\n")
    (tmp_path / "users" / "two.csv").write_text("user,query,class\nu1,d.b.c,tun\n,e.b.c,tun\n")
    (tmp_path / "dgta").mkdir()
    frame = pd.DataFrame({"domain": ["b\xfccher.de".encode("latin-1"), b"abc.com"], "class": ["legit", "dga"], "__index_level_0__": [0, 1]})
    frame.to_parquet(tmp_path / "dgta" / "dgta-benchmark.parquet")
    return str(tmp_path)


def test_header_csv(spark, base):
    got = D.read_listed_domains(spark, f"{base}/360_dga_domain.csv")
    assert got.columns == ["query", "class"] and got.count() == 3
    assert [r.query for r in D.read_dataset(spark, base, "dga").collect()] == ["abc.com"]


def test_class_from_file_name_and_cap(spark, base):
    got = D.read_family_files(spark, f"{base}/dgarchive/*.csv", rows_per_file=3)
    assert got.groupBy("class").count().orderBy("class").collect() == [("conficker", 3), ("nymaim", 1)]
    assert {r.query for r in got.filter("class = 'conficker'").collect()} == {"d0.net", "d1.net", "d2.net"}
    assert D.read_family_files(spark, f"{base}/dgarchive/*.csv", rows_per_file=-1).count() == 6


def test_space_separated_logs(spark, base):
    got = D.read_text_logs(spark, f"{base}/textlogs/*.txt").orderBy("query").collect()
    assert got == [("mail.uni.de", "legit"), ("www.uni.de", "legit")]
    times = {r.query: r.timestamp for r in D.parsed_text_logs(spark, f"{base}/textlogs/*.txt").collect()}
    assert times["mail.uni.de"] is None and times["www.uni.de"] is not None


def test_latin1_bytes(spark, base):
    got = D.read_latin1_domains(spark, f"{base}/dgta/dgta-benchmark.parquet")
    assert sorted(r.query for r in got.collect()) == ["abc.com", "b\xfccher.de"]
    assert got.columns == ["query", "class"]


def test_optional_user_column(spark, base):
    rows = D.load_dataset(spark, base, "tunnel", {"tunnel": "users/one.csv,users/two.csv"}).select("user", "query").collect()
    assert sorted(rows) == [("testbed", "a.b.c"), ("testbed", "a.b.c"), ("testbed", "e.b.c"), ("u1", "d.b.c")]


def test_combined_choice(spark, base):
    got = D.load_dataset(spark, base, "combine").groupBy("dataset").count().collect()
    assert dict(map(tuple, got)) == {"dgta": 2, "bambenek": 1, "dga": 1, "textlogs": 2, "dgarchive": 6}
    with pytest.raises(NotImplementedError):
        D.load_dataset(spark, base, "absent")


def test_gzip_json_lines(spark, tmp_path):
    row = {"query": "a.b", "labels": ["a", "b"], "tld": "b", "fqdn": "a.b", "secondleveldomain": "a", "thirdleveldomain": "", "class": 1}
    with gzip.open(tmp_path / "e.json.gz", "wt") as f:
        f.write(json.dumps(row) + "\n")
    got = D.read_evaluation(spark, str(tmp_path / "*.json.gz")).first()
    assert got["class"] == 1 and got.labels == ["a", "b"]


def test_conform_checks_columns_and_types(spark):
    df = spark.createDataFrame([("m", "t", T0)], "message_id string, event string, event_timestamp timestamp")
    assert schemas.conform(df.select(*reversed(df.columns)), "server_logs_timestamps").columns == df.columns
    with pytest.raises(ValueError):
        schemas.conform(df.drop("event"), "server_logs_timestamps")
    with pytest.raises(TypeError):
        schemas.conform(df.withColumn("event", F.lit(1)), "server_logs_timestamps")
    with pytest.raises(ValueError):
        schemas.conform(df, "absent")
    tree = spark.createDataFrame([("r", "b", None, "i", "s", "x", T0)], schemas.TABLES["batch_tree"])
    assert schemas.conform(tree, "batch_tree").first().parent_batch_row_id == ""
    assert len(schemas.TABLES) == 14


def test_event_rows_that_do_not_fit_are_set_aside(spark):
    rows = [
        {"timestamp": "2024-01-01 00:00:00", "stage": "s", "entry_type": "e", "entry_count": 3},
        {"timestamp": "2024-01-01 00:00:00", "stage": "s", "entry_type": None, "entry_count": 3},
        {"timestamp": "2024-01-01 00:00:00", "stage": "s", "entry_type": "e", "entry_count": "many"},
        {"timestamp": "2024-01-01 00:00:00", "stage": "s", "entry_type": "e"},
        {"timestamp": "x", "stage": "s", "entry_type": "e", "entry_count": 3},
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in rows] + [("junk",)], "value string")
    good, bad = schemas.split_typed(df, "fill_levels")
    assert good.count() == 2 and bad.count() == 4


def test_replayed_micro_batches_replace_themselves(spark, tmp_path):
    root = str(tmp_path / "tables")
    rows = [(T0 + dt.timedelta(days=d), "s", "e", d) for d in range(3)]
    df = spark.createDataFrame(rows, schemas.TABLES["fill_levels"])
    for batch in (0, 1, 1, 0):
        sinks.append_events(df, "fill_levels", root, batch)
    got = sinks.read_events(spark, "fill_levels", root)
    assert got.count() == 6
    assert {r.month for r in got.select("month").distinct().collect()} == {"2024-01", "2024-02"}
    assert sinks.expire_table(spark, root, "fill_levels", T0 + dt.timedelta(days=1)) == 0
    assert sinks.expire_table(spark, root, "fill_levels", T0 + dt.timedelta(days=2)) == 1
    assert {r.month for r in sinks.read_events(spark, "fill_levels", root).collect()} == {"2024-02"}


@pytest.mark.parametrize("setting,days", [(None, None), ("3", 3), (0, 1), (-4, 1), ("x", 7), ([], 7)])
def test_retention_setting(setting, days):
    assert sinks.retention_days(setting) == days


def test_alert_files_per_day(spark, tmp_path):
    path = str(tmp_path / "alerts")
    days = [dt.datetime(2026, 6, d, 12, tzinfo=dt.timezone.utc) for d in (22, 23, 24, 25)]
    df = spark.createDataFrame([("192.0.2.1", d) for d in days], "src_ip string, alert_timestamp timestamp")
    sinks.write_alert_files(df, path)
    (tmp_path / "alerts" / "alert_date=other").mkdir()
    assert sinks.expire_alert_files(spark, path, None, dt.date(2026, 6, 25)) == 0
    assert sinks.expire_alert_files(spark, path, 3, dt.date(2026, 6, 25)) == 1
    left = sorted(p.name for p in (tmp_path / "alerts").iterdir() if p.name.startswith("alert_date"))
    assert left == ["alert_date=2026-06-23", "alert_date=2026-06-24", "alert_date=2026-06-25", "alert_date=other"]
    text = next((tmp_path / "alerts" / "alert_date=2026-06-25").glob("*.json")).read_text()
    assert json.loads(text)["src_ip"] == "192.0.2.1"


def test_topic_rows(spark):
    df = spark.createDataFrame([("1.2.3.4", 0.5)], "src_ip string, overall_score double")
    row = sinks.topic_rows(df).first()
    assert row.key == "1.2.3.4" and json.loads(row.value) == {"src_ip": "1.2.3.4", "overall_score": 0.5}
    assert sinks.topic_options(["a:1", "b:2"], "t")["kafka.bootstrap.servers"] == "a:1,b:2"


def test_envelope_elements(spark):
    element = "logline_id string, domain_name string"
    a, b = {"logline_id": "1", "domain_name": "x"}, {"logline_id": "2", "domain_name": "y"}
    envelope = {
        "batch_tree_row_id": "r", "batch_id": "b", "begin_timestamp": "2024-01-01T00:00:00.000001",
        "end_timestamp": "2024-01-01T00:00:01.000000", "data": [a, json.dumps(b), [a, b], 5],
    }
    df = spark.createDataFrame([(json.dumps(envelope),)], "value string")
    got = sinks.from_envelope(df, element).orderBy("place").collect()
    assert [[m.logline_id for m in r.messages or []] for r in got] == [["1"], ["2"], ["1", "2"], []]
    assert [r.is_broken for r in got] == [False, False, False, True]
    assert [r.is_window for r in got] == [False, False, True, False]
    assert got[0].begin_timestamp.microsecond == 1
    batch = spark.createDataFrame([("r", "b", T0, T0, [("1", "x")])], f"batch_tree_row_id string, batch_id string, begin_timestamp timestamp, end_timestamp timestamp, data array<struct<logline_id:string,domain_name:string>>")
    back = sinks.from_envelope(sinks.to_envelope(batch), element).first()
    assert back.messages[0].domain_name == "x" and back.begin_timestamp == batch.first().begin_timestamp


def test_two_stages_fill_one_table(spark, tmp_path):
    root = str(tmp_path / "tables")
    df = spark.createDataFrame([(T0, "s", "e", 1)], schemas.TABLES["fill_levels"])
    for writer in ("prefilter", "inspector", "prefilter"):
        sinks.append_events(df, "fill_levels", root, 0, writer)
    assert sorted(r.writer for r in sinks.read_events(spark, "fill_levels", root).collect()) == ["inspector", "prefilter"]


def test_replayed_alert_files(spark, tmp_path):
    path = str(tmp_path / "alerts")
    df = spark.createDataFrame([("192.0.2.1", T0)], "src_ip string, alert_timestamp timestamp")
    for batch in (0, 1, 1):
        sinks.write_alert_files(df, path, batch)
    assert spark.read.json(path).count() == 2


def test_family_files_are_read_whole(spark, tmp_path):
    (tmp_path / "fam_dga.csv").write_text("\n".join(f"d{i}.example,x" for i in range(10_500)))
    assert D.read_family_files(spark, str(tmp_path / "*.csv")).count() == 10_500
