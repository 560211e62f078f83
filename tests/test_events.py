"""Monitoring tables: committed at once, complete, and fit for the engine's own latencies."""

from __future__ import annotations

import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from siltwatch.functions.rules import LogFormat
from siltwatch.operators.batching import BatchSpec
from siltwatch.operators.series import StepSpec
from siltwatch.plans import flow
from siltwatch.plans import latency as L
from siltwatch.sources.event_log import EventLog, StageClock
from siltwatch.sources.schemas import TABLES
from siltwatch.streaming import jobs

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
FORMAT = LogFormat.parse(
    [["ts", "Timestamp", "%Y-%m-%dT%H:%M:%S"], ["status_code", "ListItem", ["NOERROR", "NXDOMAIN"], ["NXDOMAIN"]], ["src_ip", "IpAddress"],
     ["domain_name", "RegEx", r"^[a-z0-9.]+$"], ["size", "RegEx", r"^\d+$"]]
)
LINE = "message_id string, timestamp_in timestamp, value string"


def lines(spark, first, n):
    rows = []
    for i in range(first, first + n):
        value = json.dumps({
            "ts": f"2024-01-01T00:{i // 240:02}:{i // 4 % 60:02}", "status_code": "NXDOMAIN" if i % 3 else "NOERROR",
            "src_ip": f"10.0.{i % 2}.{i % 5}", "domain_name": f"{hashlib.md5(str(i).encode()).hexdigest()[: 4 + i % 9]}.a{i % 3}.com", "size": "10" if i % 10 else "bad", "other": i,
        })
        rows.append((f"00000000-0000-4000-8000-{i:012}", T0, value))
    return spark.createDataFrame(rows, LINE)


CHAIN = (
    {"name": "tunnel", "detector": "TunnelDetector", "inspector_name": "c", "settings": {"threshold": 0.5, "sha256": "v1"}, "next_detectors": ["tool"]},
    {"name": "tool", "detector": "AttributionDetector", "consume_from": "detector", "settings": {"threshold": 0.1, "labels": ("benign", "dnscat2")}},
    {"name": "dga", "detector": "DGADetector", "inspector_name": "c", "settings": {"threshold": 0.6}, "send_to_alerter": False},
)


def job(root, **args):
    spec = flow.InspectSpec(step=StepSpec(1, "s"), window=5, score_threshold=0.1, anomaly_threshold=0.01)
    return jobs.DetectionJob(FORMAT, str(root), BatchSpec(size=1000), inspection=spec, **args)


def fill(spark, table, days):
    column = {"alerts": "alert_timestamp"}.get(table, "timestamp")
    rows = [(i, T0 + dt.timedelta(days=d)) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, f"i bigint, {column} timestamp")
    if table == "alerts":
        return df.select(F.lit("c").alias("src_ip"), column, F.col("i").cast("string").alias("suspicious_batch_id"), F.lit(0.5).cast("float").alias("overall_score"), F.lit("[]").alias("domain_names"), F.lit("[]").alias("result"))
    return df.select(column, F.lit("s").alias("stage"), F.lit("k").alias("entry_type"), F.col("i").alias("entry_count"))


def test_all_tables_of_a_micro_batch_show_at_once(spark, tmp_path):
    log = EventLog(str(tmp_path), every=4)
    seen = lambda t: sorted(r[0] for r in log.read(spark, t).select("entry_count" if t == "fill_levels" else "suspicious_batch_id").collect())
    for n in range(9):
        assert not log.committed(spark, n)
        if n == 5:  # a try that stops between the write and the commit, with other rows
            log.write(spark, [("fill_levels", fill(spark, "fill_levels", [9, 9, 9])), ("alerts", fill(spark, "alerts", [7]))], n)
            assert seen("fill_levels") == [0] * n and seen("alerts") == ["0"] * n
        log.write(spark, [("fill_levels", fill(spark, "fill_levels", [n])), ("alerts", fill(spark, "alerts", [n]))], n)
        assert len(seen("fill_levels")) == n
        log.commit(spark, n)
        assert log.committed(spark, n) and len(seen("fill_levels")) == len(seen("alerts")) == n + 1
    names = sorted(p.name for p in (tmp_path / "commits").iterdir() if not p.name.startswith("."))
    assert names == ["8", "whole-7-1"]
    assert log.read(spark, "loglines").count() == 0


def test_expiry_cuts_the_border_day(spark, tmp_path):
    log = EventLog(str(tmp_path))
    log.write(spark, [("fill_levels", fill(spark, "fill_levels", [0, 1.25, 1.75, 2.5])), ("alerts", fill(spark, "alerts", [0, 2]))], 0)
    log.commit(spark, 0)
    gone = log.expire(spark, T0 + dt.timedelta(days=2.5))
    assert sorted(r.entry_count for r in log.read(spark, "fill_levels").collect()) == [2, 3]
    assert log.read(spark, "alerts").count() == 2 and set(gone) == {"fill_levels"}
    assert log.committed(spark, 0) and not log.committed(spark, 1)
    days = {p.name for p in (tmp_path / "rows" / "table_name=fill_levels").rglob("*.parquet")}
    assert len(days) == len([x for x in log.files(spark) if x.parts[0] == "fill_levels"])
    log.write(spark, [("fill_levels", fill(spark, "fill_levels", [2.75]))], 1)
    log.commit(spark, 1)
    assert log.read(spark, "fill_levels").count() == 3
    assert log.read(spark, "fill_levels", (T0 + dt.timedelta(days=2)).date()).count() == 2


def test_stage_times_are_noted_once(spark, tmp_path):
    clock = StageClock(str(tmp_path))
    first = clock.at(spark, 3, "a")
    assert clock.at(spark, 3, "a") == first <= clock.at(spark, 3, "b")


class Stopped(Exception):
    pass


@pytest.fixture(scope="module")
def plain(spark, tmp_path_factory):
    """Two micro-batches that ended at once."""
    own = job(tmp_path_factory.mktemp("plain"), detectors=CHAIN)
    for n in range(2):
        own(lines(spark, 60 * n, 60), n)
    return own


def test_a_killed_micro_batch_is_replayed_without_a_trace(spark, plain, tmp_path, monkeypatch):
    """The same tables, whether a micro-batch ended at once or was stopped before or after its rows were written."""
    hurt = job(tmp_path, detectors=CHAIN)
    for n, place in enumerate(["write", "commit"]):
        with monkeypatch.context() as m:

            def stop(*_):
                raise Stopped

            m.setattr(EventLog, place, stop)
            with pytest.raises(Stopped):
                hurt(lines(spark, 60 * n, 60), n)
        assert hurt.log.read(spark, "server_logs").count() == 60 * n
        hurt(lines(spark, 60 * n, 60), n)
        hurt(lines(spark, 60 * n, 60), n)  # delivered again after the commit
    for table in TABLES:
        times = [c for c in plain.log.read(spark, table).columns if "timestamp" in c]
        bare = lambda j: sorted(map(repr, j.log.read(spark, table).drop(*times).collect()))  # noqa: B023, E731
        assert bare(plain) == bare(hurt), table


def test_latencies_of_the_engines_own_output(spark, plain):
    read = lambda t: plain.log.read(spark, t)
    assert {t for t in TABLES if read(t).count() == 0} == set()
    assert read("server_logs").count() == 120 and read("failed_loglines").count() == 12
    assert len({json.loads(r.additional_fields).get("other") for r in read("loglines").collect()}) == 108
    result = F.explode(F.from_json("result", "array<struct<name:string,sha256:string>>")).alias("w")
    versions = read("alerts").select(result).select("w.*").distinct().collect()
    assert {r["name"]: r.sha256 for r in versions} == {"tunnel": "v1", "tool": ""}

    logs, line_events = read("server_logs"), read("logline_timestamps")
    assert L.server_log_latencies(logs, read("server_logs_timestamps")).count() == 120
    stages = {r.stage for r in L.stage_latencies(L.logline_states(line_events)).select("stage").distinct().collect()}
    assert stages == {"log_collection.collector"}
    batches = L.stage_latencies(L.batch_states(read("batch_timestamps"))).select("stage").distinct().collect()
    assert {r.stage for r in batches} >= {"log_filtering.prefilter"}
    clients = read("suspicious_batches_to_batch").count()
    ends = L.stage_latencies(L.suspicious_states(read("suspicious_batch_timestamps"))).groupBy("instance_name").count()
    ends = {r.instance_name: r["count"] for r in ends.collect()}
    assert ends["tunnel"] == ends["dga"] == clients and 0 < ends["tool"] <= clients
    hops = {r.stage: r["count"] for r in L.transport_latencies(read("batch_tree")).groupBy("stage").count().collect()}
    done = read("batch_timestamps").filter("stage = 'log_collection.batch_handler' AND status = 'completed'").count()
    assert hops["transport.batch_handler_to_prefilter"] == done and hops["transport.inspector_to_detector"] >= clients
    trips = L.roundtrip_latencies(logs, read("server_log_to_logline"), line_events, read("server_log_terminal_events"))
    assert trips.count() == 120  # every message ends somewhere
    assert {r.status for r in read("server_log_terminal_events").collect()} == {"failed", "processed"}


def test_windows_go_on_over_micro_batches(spark, plain):
    state = spark.read.parquet(f"{plain.root}/state/queues-tunnel/touched")
    last = state.groupBy("secondleveldomain", "stream_batch").agg(F.max("arrived").alias("n")).groupBy("stream_batch").agg(F.sum("n").alias("n"))
    counts = {r.stream_batch: r.n for r in last.collect()}
    assert counts[1] > counts[0] > 0


def test_a_listener_that_nobody_names_is_an_error(spark):
    with pytest.raises(ValueError):
        flow.run_detectors(spark.range(0), [CHAIN[1]])
    with pytest.raises(NotImplementedError):
        flow.run_detectors(spark.range(0), [{"name": "x", "detector": "Absent", "inspector_name": "i"}])


@pytest.mark.parametrize("name", ["newest", "recent_and_typical"])
def test_latency_values_are_computed_once(spark, monkeypatch, name):
    """Values that a query reads twice are written, and both uses read the written table."""
    from siltwatch.catalog import monitoring

    written = []
    real = monitoring.staged
    monkeypatch.setattr(monitoring, "staged", lambda df, label: written.append(label) or real(df, label))
    out = getattr(monitoring, name)(spark, "/root/testdata/sf0.001")
    assert written == ["latency-values"]
    assert "lineitem.parquet" not in out._jdf.queryExecution().executedPlan().toString()
