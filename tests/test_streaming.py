from __future__ import annotations

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from siltwatch.functions.rules import LogFormat
from siltwatch.operators.batching import BatchSpec
from siltwatch.operators.series import StepSpec
from siltwatch.plans import flow
from siltwatch.sources import sinks
from siltwatch.streaming import jobs, sources

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
LINE = "logline_id bigint, subnet_id string, ts timestamp"


def micro_batches(seed, n):
    """Lines per micro-batch; one key holds most of them."""
    rng, out, i = random.Random(seed), [], 0
    for b in range(n):
        rows = []
        for _ in range(rng.randrange(1, 25)):
            key = "hot" if rng.random() < 0.6 else f"k{rng.randrange(3)}"
            rows.append((i, key, T0 + dt.timedelta(seconds=60 * b + rng.random() * 50)))
            i += 1
        out.append(rows)
    return out


def simulate(batches, size):
    batch, buffer, sent = {}, {}, []

    def complete(key, b):
        if batch.get(key):
            sent.append((b, key, tuple(buffer.get(key, ())), tuple(batch[key])))
            buffer[key] = batch.pop(key)
        else:
            buffer.pop(key, None)

    for b, rows in enumerate(batches):
        for i, key, _ in sorted(rows, key=lambda r: (r[2], r[0])):
            batch.setdefault(key, []).append(i)
            if len(batch[key]) >= size:
                complete(key, b)
        for key in set(batch) | set(buffer):
            complete(key, b)
    return sorted(sent)


def collected(spark, root):
    groups = {}
    for r in spark.read.parquet(f"{root}/sent").orderBy("batch_id", "position").collect():
        groups.setdefault((r.stream_batch, r.subnet_id, r.batch_id), []).append((r.is_buffer, r.logline_id))
    return sorted((b, k, tuple(i for f, i in g if f), tuple(i for f, i in g if not f)) for (b, k, _), g in groups.items())


def test_micro_batch_flushes_match_simulation_and_survive_replay(spark, tmp_path):
    batches = micro_batches(5, 6)
    job = jobs.BatchingJob(BatchSpec(size=4, slot_seconds=10), str(tmp_path))
    for number in (0, 1, 1, 2, 3, 2, 3, 4, 5):
        job(spark.createDataFrame(batches[number], LINE), number)
    assert collected(spark, tmp_path) == simulate(batches, 4)


def test_stream_of_files_drains_into_batches(spark, tmp_path):
    batches = micro_batches(8, 3)
    source = tmp_path / "in"
    for b, rows in enumerate(batches):
        spark.createDataFrame(rows, LINE).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(LINE).parquet(str(source))
        query = jobs.run(stream, jobs.BatchingJob(BatchSpec(size=4), str(tmp_path / "out")), str(tmp_path / "check"))
        assert query.awaitTermination(120)
        assert query.exception() is None
    assert collected(spark, tmp_path / "out") == simulate(batches, 4)


def test_late_lines_go_aside(spark, tmp_path):
    on_time, late = [], []
    keep = lambda store: lambda df, _: store.extend(r.logline_id for r in df.collect())
    job = jobs.LateLines(60, str(tmp_path), keep(on_time), keep(late))
    first = [(1, "a", T0 + dt.timedelta(seconds=100))]
    second = [(2, "a", T0 + dt.timedelta(seconds=39)), (3, "a", T0 + dt.timedelta(seconds=40)), (4, "a", T0 + dt.timedelta(seconds=500))]
    job(spark.createDataFrame(first, LINE), 0)
    job(spark.createDataFrame(second, LINE), 1)
    assert (sorted(on_time), late) == ([1, 3, 4], [2])


def test_alert_rollup_stream_closes_buckets(spark, tmp_path):
    schema = "src_ip string, alert_timestamp timestamp"
    rows = [("a", T0), ("a", T0 + dt.timedelta(seconds=30)), ("b", T0 + dt.timedelta(seconds=90)), ("a", T0 + dt.timedelta(hours=1))]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = jobs.alert_rollup_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), 1, "5 minutes")
    out = str(tmp_path / "out")
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    assert sorted((r.src_ip, r.alert_count) for r in spark.read.parquet(out).collect()) == [("a", 2), ("b", 1)]


def test_ingest_stamp_is_stable_under_replay(spark, tmp_path):
    df = spark.createDataFrame([(None, "x", "t", 1, 2, T0), (None, "x", "t", 1, 3, T0)], "key string, value string, topic string, partition bigint, offset bigint, timestamp timestamp")
    ids = [r.message_id for r in sources.stamped(df).collect()]
    assert ids == [r.message_id for r in sources.stamped(df).collect()] and len(set(ids)) == 2
    assert all(len(i) == 36 for i in ids)
    logs, outs = sources.server_log_rows(sources.stamped(df, replay=False))
    assert logs.count() == 2 and outs.first().event == "timestamp_out"
    options = sources.topic_source(["b:1"], ["t"], 5)
    assert options["kafka.isolation.level"] == "read_committed" and options["startingOffsets"] == "earliest"


def test_equal_lines_are_lines_of_their_own(spark, tmp_path):
    lines = ["same", "same", "other", "same", *[f"line {i % 4}" for i in range(3000)]]
    (tmp_path / "in").mkdir()
    for name in ("a.txt", "b.txt"):
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")
    seen = []

    def job(rows, number):
        seen.append({(r.message_id, r.partition, r.offset): r.value for r in rows.collect()})

    for k, piece in enumerate(["134217728", "4000", "4000"]):  # cut otherwise, and replayed
        spark.conf.set("spark.sql.files.maxPartitionBytes", piece)
        try:
            query = jobs.run(sources.file_stream(spark, str(tmp_path / "in")), sources.reading_files(job, "dns"), str(tmp_path / f"check{k}"))
            assert query.awaitTermination(120)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(seen) == 3 and seen[0] == seen[1] == seen[2]
    assert len({m for m, _, _ in seen[0]}) == 2 * len(lines)
    for partition in {p for _, p, _ in seen[0]}:
        assert [v for (_, p, _), v in sorted(seen[0].items(), key=lambda x: x[0][2]) if p == partition] == lines


FORMAT = LogFormat.parse(
    [["ts", "Timestamp", "%Y-%m-%dT%H:%M:%S"], ["status_code", "ListItem", ["NOERROR", "NXDOMAIN"], ["NXDOMAIN"]], ["src_ip", "IpAddress"],
     ["domain_name", "RegEx", r"^[a-z0-9.]+$"], ["size", "RegEx", r"^\d+$"]]
)


def test_lines_to_alerts_in_one_stream(spark, tmp_path):
    lines = []
    for i in range(120):
        second = i // 4 if i < 80 else 40
        lines.append(json.dumps({
            "ts": f"2024-01-01T00:00:{second:02}", "status_code": "NXDOMAIN" if i % 3 else "NOERROR",
            "src_ip": f"10.0.{i % 2}.{i % 5}", "domain_name": f"q{i}x7w{i * 7}z.com", "size": "10" if i % 10 else "bad",
        }))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join([*lines, "broken"]) + "\n")
    forwarded = []
    job = jobs.DetectionJob(
        FORMAT, str(tmp_path / "out"), BatchSpec(size=1000),
        inspection=flow.InspectSpec(step=StepSpec(1, "s"), window=5, anomaly_threshold=0.01),
        settings={"name": "dga", "threshold": 0.6},
        alert_sinks=(lambda alerts, n: forwarded.extend(r.src_ip for r in alerts.collect()),),
    )
    stream = sources.file_stream(spark, str(tmp_path / "in"))
    query = jobs.run(stream, sources.reading_files(job, "dns"), str(tmp_path / "check"))
    assert query.awaitTermination(180)
    read = lambda t: job.log.read(spark, t)
    failed = read("failed_loglines")
    sent = spark.read.parquet(str(tmp_path / "out" / "batches" / "sent"))
    assert failed.count() == 13 and sent.count() == 108
    assert {r.reason_for_failure for r in failed.collect()} == {"size", "json"}
    dropped = read("logline_timestamps").filter("stage = 'log_filtering.prefilter'").count()
    assert dropped == sent.filter("status_code = 'NOERROR'").count()
    alerts = read("alerts").collect()
    assert sorted(a.src_ip for a in alerts) == sorted(forwarded)
    assert forwarded and all(json.loads(a.domain_names) and json.loads(a.result)[0]["name"] == "dga" for a in alerts)
