"""Quantiles by selection, states by increments, and tiers that expire."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltwatch.plans import latency as L
from siltwatch.plans import rollups as R
from siltwatch.plans.quantiles import described, slot_of
from siltwatch.sources.event_log import EventLog
from siltwatch.streaming.increments import expire_tiers, refresh, state_tables

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


@pytest.mark.parametrize("limit", [0, 40, 10_000])
def test_quantiles_by_selection_equal_those_of_a_sort(spark, limit):
    rng = random.Random(limit)
    values = {
        "wide": [rng.lognormvariate(0, 3) for _ in range(900)], "ties": [rng.choice([1.0, 2.0, 2.5]) for _ in range(700)],
        "one": [7.0] * 50, "two": [1.0, 4.0], "minus": [-rng.random() for _ in range(300)], None: [float(i) for i in range(120)],
    }
    rows = [(k, v) for k, own in values.items() for v in own] + [("none", None), ("two", None)]
    rng.shuffle(rows)
    qs = [0.0, 0.25, 0.5, 0.95, 0.99, 1.0]
    got = {r.k: r for r in described(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", qs, limit).collect()}
    assert set(got) == set(values)
    for k, r in got.items():
        own = values[k]
        assert (r.n, r.low, r.high) == (len(own), min(own), max(own)) and r.mean == pytest.approx(np.mean(own))
        assert r.q == pytest.approx(np.quantile(own, qs).tolist(), abs=1e-12)


def test_slots_count_the_borders_passed(spark):
    df = spark.createDataFrame([(v / 4, [1.0, 2.0, 2.5, 9.0]) for v in range(44)] + [(1.0, [])], "v double, cuts array<double>")
    for r in df.select("v", "cuts", slot_of(F.col("v"), F.col("cuts")).alias("slot")).collect():
        assert r.slot == sum(c < r.v for c in r.cuts)


def events(spark, first, n):
    at = lambda i, s=0: T0 + dt.timedelta(hours=7 * (i % 40), seconds=s)
    ids = range(first, first + n)
    lines = [(f"l{i}", "x.y", s, at(i, k), True) for i in ids for k, s in enumerate(("in_process", "finished"))]
    batches = [(f"b{i}", "c", "x.y", s, at(i, k), 1, True) for i in ids for k, s in enumerate(("in_process", "finished"))]
    return [
        ("server_logs", spark.createDataFrame([(f"m{i}", at(i), "t") for i in ids], "message_id string, timestamp_in timestamp, message_text string")),
        ("server_logs_timestamps", spark.createDataFrame([(f"m{i}", "timestamp_out", at(i, 3)) for i in ids], "message_id string, event string, event_timestamp timestamp")),
        ("logline_timestamps", spark.createDataFrame(lines, "logline_id string, stage string, status string, timestamp timestamp, is_active boolean")),
        ("batch_timestamps", spark.createDataFrame(batches, "batch_id string, instance_name string, stage string, status string, timestamp timestamp, message_count bigint, is_active boolean")),
        ("fill_levels", spark.createDataFrame([(at(i), "s", "k", i) for i in ids], "timestamp timestamp, stage string, entry_type string, entry_count bigint")),
        ("alerts", spark.createDataFrame([(f"c{i % 3}", at(i), f"s{i}", 0.5, "[]", "[]") for i in ids], "src_ip string, alert_timestamp timestamp, suspicious_batch_id string, overall_score float, domain_names string, result string")),
    ]


def plain(df):
    return sorted(map(repr, df.collect()))


def test_increments_add_up_to_one_run(spark, tmp_path):
    log, tables = EventLog(str(tmp_path / "log")), state_tables(str(tmp_path / "states"))
    for n in range(3):
        log.write(spark, events(spark, 30 * n, 30), n)
        log.commit(spark, n)
        refresh(log, tables, spark, n, fewest=3)
        refresh(log, tables, spark, n, fewest=3)  # again: nothing is added twice
    read = lambda t: log.read(spark, t)
    order = lambda name: tables[name].read(spark).columns
    whole = {
        "logline": L.logline_states(read("logline_timestamps")), "batch": L.batch_states(read("batch_timestamps")),
        "server_log": L.server_log_states(read("server_logs"), read("server_logs_timestamps")),
        "alerts_15m": R.alert_rollup(read("alerts"), 15),
    }
    for name, want in whole.items():
        assert plain(tables[name].read(spark)) == plain(want.select(*order(name))), name
    assert tables["suspicious"].read(spark).count() == 0
    fills = R.finish_fill_states(tables["fill_levels_1h"].read(spark)).drop("median_count")
    want = R.fill_rollup(read("fill_levels"), 60).select(*fills.columns)
    assert plain(fills) == plain(want)
    merged = {x.parts[0] for x in tables["alerts_1h"].log.files(spark) if x.batch.startswith("-")}
    assert merged and all(len([x for x in tables["alerts_1h"].log.files(spark) if x.parts[0] == d and not x.batch.startswith("-")]) < 3 for d in merged)
    since = (T0 + dt.timedelta(days=5)).date()
    assert {r.event_date for r in tables["logline"].read(spark, since).collect()} == {r.event_date for r in whole["logline"].collect() if r.event_date >= since}


def test_tiers_keep_their_days(spark, tmp_path):
    tables = state_tables(str(tmp_path))
    alerts = spark.createDataFrame([("c", T0 + dt.timedelta(hours=5 * i)) for i in range(600)], "src_ip string, alert_timestamp timestamp")
    as_of = T0 + dt.timedelta(hours=5 * 600 + 7)
    for t in R.TIERS:
        tables[f"alerts_{t.name}"].add(spark, R.alert_rollup(alerts, t.minutes), 0)
    gone = expire_tiers(tables, spark, as_of)
    for t in R.TIERS:
        table = tables[f"alerts_{t.name}"]
        want = [r.time_bucket for r in R.alert_rollup(alerts, t.minutes).collect() if r.time_bucket >= (as_of - t.kept).replace(tzinfo=None)]
        assert sorted(r.time_bucket for r in table.read(spark).collect()) == sorted(want)
        days = {p.parent.parent.name for p in (tmp_path / f"alerts_{t.name}" / "rows").rglob("*.parquet")}
        assert min(days) == f"day={(as_of - t.kept).date()}" and gone[f"alerts_{t.name}"] > 0
    assert gone["fill_levels_1m"] == 0
