from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltwatch.operators import alerts as A
from siltwatch.operators import detection as X
from siltwatch.operators import routing
from siltwatch.operators import tunnel as T
from siltwatch.plans import flow

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
LINE = "suspicious_batch_id string, src_ip string, logline_id string, server_message_id string, domain_name string, ts timestamp, probability double"


def rows(spark, n=4, probability=lambda i: 0.9):
    made = [("s", "1.2.3.4", f"l{i:03}", f"m{i}", f"d{i}.com", T0 + dt.timedelta(seconds=i), probability(i)) for i in range(n)]
    return spark.createDataFrame(made, LINE)


def test_ties_and_thresholds(spark):
    df = rows(spark, 5, lambda i: [0.5, 0.50001, 0.7, 0.70001, 1.0][i])
    assert X.binary_warnings(df, "d", 0.2).count() == 4
    assert X.binary_warnings(df, "d", 0.7).count() == 2
    assert X.binary_warnings(df, "d", 0.7, always=True).count() == 5
    assert X.binary_warnings(df, "d").columns == list(X.WARNING_COLUMNS)


@pytest.mark.parametrize(
    "probabilities,want",
    [
        ([0.6, 0.4, 0.0], None),
        ([0.3, 0.5, 0.2], ("x", 0.5, ["x"])),
        ([0.1, 0.45, 0.45], None),
        ([0.0, 0.5, 0.5], ("x", 0.5, ["x", "y"])),
    ],
)
def test_attribution(spark, probabilities, want):
    df = spark.createDataFrame([("s", "i", probabilities, [("l", None, "d", T0)])], f"suspicious_batch_id string, src_ip string, probabilities array<double>, request {X.REQUEST}")
    got = X.attribution_warnings(df, ["legit", "x", "y"], "a", 0.5).collect()
    if want is None:
        assert got == []
    else:
        assert (got[0].predicted_class, got[0].probability, [a.attribute for a in got[0].attributes]) == want


@pytest.mark.parametrize("label", X.LEGITIMATE)
def test_legitimate_winners_never_warn(spark, label):
    df = spark.createDataFrame([("s", "i", [0.9, 0.1], [("l", None, "d", T0)])], f"suspicious_batch_id string, src_ip string, probabilities array<double>, request {X.REQUEST}")
    assert X.attribution_warnings(df, [label, "x"], "a", 0.05).count() == 0


def test_compact_warnings_cut_sorted_lists(spark):
    df = rows(spark, 130)
    window = df.groupBy("suspicious_batch_id", "src_ip").agg(F.collect_list(X.request_entry(df)).alias("r"), F.max("probability").alias("probability"))
    warned = X.binary_warnings(window, "d", 0.5, request=F.col("r"))
    w = warned.select(A.compact_warning().alias("w")).first().w
    assert w.request_count == 130
    assert w.domain_names == sorted(f"d{i}.com" for i in range(130))[:50]
    assert w.logline_ids == [f"l{i:03}" for i in range(100)]
    assert w.server_message_ids == sorted(f"m{i}" for i in range(130))[:100]
    assert "request" not in w.asDict()
    full = warned.select(A.persisted_warning("fallback").alias("w")).first().w
    assert (full.score, full.probability, full.detector_name, full.predicted_class, full.attributes) == (0.9, 0.9, "d", "", [])
    assert len(full.domains) == len(full.logline_ids) == 130
    assert full.raw_detector_output.name == "d"


def test_alert_per_client_batch(spark):
    df = rows(spark, 4, lambda i: [0.6, 0.8, 0.9, 0.1][i])
    alerts = A.build_alerts(X.binary_warnings(df, "d", 0.5), "d", F.lit(T0), A.compact_warning())
    row = alerts.first()
    assert (row.overall_score, row.n_warnings, row.domain_names) == (0.8, 3, ["d0.com", "d1.com", "d2.com"])
    stored = A.stored_alerts(alerts).first()
    assert stored.domain_names == '["d0.com","d1.com","d2.com"]'


def test_hooks_run_in_order(spark):
    A.alerter("one")(lambda df: df.withColumn("t", F.lit("1")))
    A.alerter("two")(lambda df: df.withColumn("t", F.concat("t", F.lit("2"))))
    df = spark.range(1)
    assert A.process_alerts(df, ["one", "two", "generic"]).first().t == "12"
    with pytest.raises(ValueError):
        A.process_alerts(df, ["absent"])


def test_only_uuids_count_as_origins(spark):
    good = "0b0f1d6e-1111-4222-8333-444455556666"
    df = spark.createDataFrame([([good, good.upper(), "x", None],)], "server_message_ids array<string>")
    assert A.originating_ids(df).first().originating_ids == [good]
    assert A.processed_events(df, F.lit(T0)).count() == 1


def test_detector_registry(spark):
    X.detector("own")(lambda lines, name: X.binary_warnings(lines, name))
    df = rows(spark).withColumn("is_buffer", F.col("logline_id") == "l000")
    assert flow.detect(df, "own", name="n").count() == 3
    assert flow.detect(df, "own", True, name="n").count() == 4
    with pytest.raises(NotImplementedError):
        flow.detect(df, "absent")


def test_events_per_line_and_batch(spark):
    df = rows(spark, 2).unionByName(rows(spark, 3).withColumn("suspicious_batch_id", F.lit("t")))
    warned = X.binary_warnings(df.filter("suspicious_batch_id = 's'"), "d")
    line_events, batch_events = X.detector_events(df, warned, "d")
    assert line_events.groupBy("status").count().orderBy("status").collect() == [("detected", 2), ("filtered_out", 3)]
    assert {(r.suspicious_batch_id, r.status, r.message_count) for r in batch_events.collect()} == {("s", "finished", 2), ("t", "filtered_out", 3)}


DETECTORS = [
    {"name": "a", "inspector_name": "i", "next_detectors": "b, c"},
    {"name": "b", "consume_from": "Detector", "produce_detector_topics": ["c", "c"], "send_to_alerter": False},
    {"name": "c", "source_detector_name": "b", "produce_topics": "x, y"},
]


def test_chained_detectors():
    assert routing.detector_edges(DETECTORS) == [("a", "b"), ("a", "c"), ("b", "c")]
    assert routing.detector_order(DETECTORS) == ["a", "b", "c"]
    assert routing.alerter_routes(DETECTORS) == [("a", "generic"), ("c", "x"), ("c", "y")]
    assert not routing.reads_from_detector({"name": "x", "consume_from": "inspector"})
    assert routing.reads_from_detector({"name": "x"})
    with pytest.raises(ValueError):
        routing.detector_order([{"name": "a", "next_detectors": "b"}, {"name": "b", "next_detectors": "a"}])
    with pytest.raises(ValueError):
        routing.detector_order([{"name": "a", "next_detectors": "b"}])


def test_consumers_by_name():
    links = [{"name": "f1", "collector_name": "c"}, {"name": "f2", "collector_name": "c"}, {"name": "f3", "collector_name": "d"}]
    assert routing.consumers(links, "collector_name") == {"c": ["f1", "f2"], "d": ["f3"]}


def test_windows_keep_the_last_ten(spark):
    made = [("s", "i", f"l{i:02}", None, f"s{i}.dom.com", T0 + dt.timedelta(seconds=i), 0.0) for i in range(40)]
    df = spark.createDataFrame(made, LINE)
    got = T.tunnel_windows(df, slot_seconds=7, chunk=10).orderBy("arrival").collect()
    assert [r.arrival for r in got] == list(range(3, 41))
    queue = []
    want = []
    for i in range(40):
        queue.append(f"s{i}")
        if len(queue) >= 3:
            want.append(list(queue))
            if len(queue) >= 10:
                del queue[0]
    assert [r.subdomains for r in got] == want
    assert [len(r.request) for r in got] == [len(w) for w in want]


def test_nested_windows_become_rows(spark):
    df = rows(spark, 3)
    warned = X.binary_warnings(df, "d")
    out = T.from_requests(warned)
    assert out.count() == 3 and set(T.CHAINED_ORDER) <= set(out.columns)
    nested = spark.createDataFrame([([[1, 2], [3]],)], "n array<array<int>>")
    assert nested.select(A.flat_messages(F.col("n"))).first()[0] == [1, 2, 3]
