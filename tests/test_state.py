"""Sparse series and state between micro-batches."""

from __future__ import annotations

import datetime as dt
import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwatch.operators import runs as R
from siltwatch.operators import scorers as S
from siltwatch.operators import tunnel as T
from siltwatch.operators.series import StepSpec, step_totals
from siltwatch.plans import flow
from siltwatch.streaming.state import KeyedState

T0 = dt.datetime(2024, 5, 21, 8, tzinfo=dt.timezone.utc)
MESSAGE = "subnet_id string, batch_id string, flush_no bigint, part bigint, ts timestamp, begin_ts timestamp, end_ts timestamp, size string"
W = 6


def messages(seed, flushes=9, longest=25):
    """Batches of a busy and a quiet subnet; some span many steps, some a single one."""
    rng, out = random.Random(seed), []
    for f in range(flushes):
        for key in ["hot"] * (1 + f % 3) + ["calm"] * (f % 2):
            part = sum(1 for r in {(r[0], r[2], r[3]) for r in out} if r[:2] == (key, f))
            span = rng.choice([0, 1, 3, longest])
            begin = T0 + dt.timedelta(seconds=1000 * f + 100 * part)
            stamps = [begin, begin + dt.timedelta(seconds=span)]
            stamps += [begin + dt.timedelta(seconds=rng.random() * span) for _ in range(rng.randrange(6))]
            out += [(key, f"{key}#{f}#{part}", f, part, t, begin, begin + dt.timedelta(seconds=span), str(rng.randrange(99))) for t in stamps]
    return out


def spec(model="ZScoreDetector", mode="univariate", ensemble=None):
    models = (model,) if isinstance(model, str) else model
    return flow.InspectSpec(mode=mode, models=models, ensemble=ensemble, step=StepSpec(1, "s"), window=W)


def steps(runs):
    return {(r.batch_id, r.step): (r.position, r.n, None if r.score is None else round(r.score, 9)) for r in R.per_step(runs).collect()}


def dense(spark, rows, one):
    """The same by a row for every step."""
    df = spark.createDataFrame(rows, MESSAGE)
    bounds = flow.message_bounds(df, one.step)
    span = R.spans(bounds, flow.KEYS, ["flush_no", "part"], F.col("flush_no"))
    points = R.placed_points(step_totals(df, one.step), span, flow.KEYS).select("batch_id", "position", "n", "mean_size")
    axis = R.expanded(span.withColumn("count", F.col("last") - F.col("first") + 1), "count", "step")
    axis = axis.withColumn("position", F.col("first") + F.col("step")).join(points, ["batch_id", "position"], "left").fillna(0.0, ["n", "mean_size"])
    out = S.score_series(axis, ["subnet_id"], one.mode, one.models, one.ensemble, W, chunk=11)
    return {(r.batch_id, r.step): (r.position, r.n, None if r.score is None else round(r.score, 9)) for r in out.collect()}


CASES = [
    spec(), spec("MadDetector"), spec("KNNDetector"), spec("SRDetector"), spec("LodaDetector", "multivariate"),
    spec(("ZScoreDetector", "SRDetector"), "ensemble", "WeightEnsemble"),
]


@pytest.mark.parametrize("one", CASES, ids=lambda c: "+".join(c.models))
def test_runs_equal_the_dense_series(spark, one):
    rows = messages(7)
    df = spark.createDataFrame(rows, MESSAGE)
    runs = flow.scored_runs(df, flow.message_bounds(df, one.step), one)
    assert steps(runs) == dense(spark, rows, one)


def test_a_month_of_small_steps_costs_what_its_messages_cost(spark):
    """Two lines 30 days apart, at 20 ms: 129,600,001 steps."""
    ends = (T0, T0 + dt.timedelta(days=30))
    df = spark.createDataFrame([("s", "b", 0, 0, t, *ends, "1") for t in ends], MESSAGE)
    one = flow.InspectSpec(window=50, score_threshold=3.0)
    runs = flow.scored_runs(df, flow.message_bounds(df, one.step), one)
    assert runs.count() <= 8
    verdict = flow.inspect(df, one).first()
    assert (verdict.n_steps, verdict.n_anomalies) == (129_600_001, 1)


@pytest.mark.parametrize("one", [CASES[0], CASES[3]], ids=["z", "sr"])
@pytest.mark.parametrize("cuts", [(1, 2, 3, 4, 5, 6, 7, 8), (4,)])
def test_any_cut_into_micro_batches_gives_the_scores_of_one_run(spark, tmp_path, one, cuts):
    rows = messages(3)
    state = KeyedState(str(tmp_path / "state"), flow.KEYS, every=3)
    got = {}
    edges = [0, *cuts, 9]
    for k, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
        some = spark.createDataFrame([r for r in rows if low <= r[2] < high], MESSAGE)
        for _ in range(2 if k == 1 else 1):  # a replay reads the same state again
            before = state.before(spark, k)
            got.update(steps(flow.scored_runs(some, flow.message_bounds(some, one.step), one, before)))
            state.put(flow.scorer_state(some, one, before), k)
    assert got == dense(spark, rows, one)
    kept = {r.subnet_id: r for r in state.before(spark, len(edges) - 1).collect()}
    assert set(kept) == {"hot", "calm"} and all(len(r.tail) < W for r in kept.values())


def test_resumed_windows_of_a_popular_label(spark, tmp_path):
    """Over 10,000 lines of one label, shuffled inside each micro-batch."""
    rng = random.Random(5)
    rows = [(i, f"s{rng.randrange(50)}.{'pop' if rng.random() < 0.95 else f'o{i % 40}'}.com", T0 + dt.timedelta(seconds=i // 3), "c") for i in range(11_500)]
    schema = "logline_id bigint, domain_name string, ts timestamp, src_ip string"
    state = KeyedState(str(tmp_path / "state"), T.KEYS, every=2)
    parts = []
    for k, (low, high) in enumerate([(0, 10_800), (10_800, 10_803), (10_803, 11_100), (11_100, 11_500)]):
        some = rows[low:high]
        rng.shuffle(some)
        before = state.before(spark, k)
        arrived = T.arrivals(spark.createDataFrame(some, schema).repartition(4), before=before)
        parts.append(T.windows_of(arrived, chunk=4000, before=before).select("logline_id", "arrival", "subdomains", "request").collect())
        state.put(T.tunnel_state(arrived, before=before), k)
    want = T.tunnel_windows(spark.createDataFrame(rows, schema)).select("logline_id", "arrival", "subdomains", "request").collect()
    got = reduce(lambda a, b: a + b, parts)
    assert sorted(got, key=lambda r: r.logline_id) == sorted(want, key=lambda r: r.logline_id)
    assert all(len(r.tail) <= T.WINDOW - 1 for r in state.before(spark, 4).collect())


def test_state_keeps_the_newest_row_of_each_key(spark, tmp_path):
    state = KeyedState(str(tmp_path / "s"), ("k",), every=3)
    want = {}

    def frame(rows) -> DataFrame:
        return spark.createDataFrame(rows, "k string, v bigint")

    for n in range(11):
        before = state.before(spark, n)
        assert (dict(map(tuple, before.collect())) if before is not None else {}) == want
        rows = [(f"k{n % 4}", n), ("all", n)]
        state.put(frame([("all", -1)]), n)  # a first try that did not last
        state.put(frame(rows), n)
        want.update(rows)
    left = sorted(p.name for p in (tmp_path / "s" / "touched").iterdir() if p.is_dir())
    assert left == [f"stream_batch={n}" for n in sorted(range(6, 11), key=str)]


def test_expanding_counts_without_long_arrays(spark):
    df = spark.createDataFrame([("a", 10), ("b", 1), ("c", 4)], "k string, n bigint")
    got = sorted((r.k, r.i) for r in R.expanded(df, "n", "i", piece=4).collect())
    assert got == [(k, i) for k, n in (("a", 10), ("b", 1), ("c", 4)) for i in range(n)]
