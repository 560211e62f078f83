from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltwatch.operators import inspection as I
from siltwatch.operators import scorers as S
from siltwatch.operators.ranking import keyed_rank
from siltwatch.operators.series import StepSpec, batch_series, step_count
from siltwatch.plans import flow

T0 = dt.datetime(2024, 5, 21, 8, 31, 28, tzinfo=dt.timezone.utc)


def at(micros):
    return T0 + dt.timedelta(microseconds=micros)


def series(spark, stamps, begin, end, spec):
    rows = [("b", at(m), at(begin), at(end), size) for m, size in stamps]
    df = spark.createDataFrame(rows or [("x", at(0), at(0), at(0), "0")], "batch_id string, ts timestamp, begin_ts timestamp, end_ts timestamp, size string")
    df = df if rows else df.limit(0)
    bounds = spark.createDataFrame([("b", at(begin), at(end))], "batch_id string, begin_ts timestamp, end_ts timestamp")
    out = batch_series(df, bounds, spec).orderBy("step").collect()
    return [r.n for r in out], [r.mean_size for r in out]


@pytest.mark.parametrize("mode", ["sum", "compat"])
def test_one_message_and_none(spark, mode):
    spec = StepSpec(20, "ms", mode)
    assert series(spark, [(1, "100b")], 0, 2, spec) == ([1, 0], [100, 0])
    assert series(spark, [], 0, 2, spec) == ([0, 0], [0, 0])


@pytest.mark.parametrize("millis,steps", [(0, 1), (19, 2), (20, 2), (21, 3)])
def test_axis_length(spark, millis, steps):
    df = spark.createDataFrame([(at(0), at(millis * 1000))], "begin_ts timestamp, end_ts timestamp")
    assert df.select(step_count(StepSpec())).first()[0] == steps


def test_counting_modes_differ_where_timestamps_share_a_step(spark):
    stamps = [(0, "10"), (0, "20"), (5_000, "40"), (25_000, "7"), (-15_000, "1"), (-25_000, "1"), (90_000, "1")]
    assert series(spark, stamps, 0, 30_000, StepSpec(20, "ms", "sum")) == ([4, 1, 0], [71 / 4, 7, 0])
    assert series(spark, stamps, 0, 30_000, StepSpec(20, "ms", "compat")) == ([1, 1, 0], [40, 7, 0])


@pytest.mark.parametrize("args", [(0, "ms"), (1, "weeks"), (1, "ms", "mean")])
def test_bad_steps(args):
    with pytest.raises(ValueError):
        StepSpec(*args)


VALUES = [1.0, 2.0, 1.0, 4.0, 1.0, 0.0, 9.0, 9.0, 9.0, 9.0, 9.0, 2.0]
W = 5


def scored(spark, **args):
    rows = [("s", i + 1, v, 3 * v) for i, v in enumerate(VALUES)]
    df = spark.createDataFrame(rows, "subnet_id string, position bigint, n double, mean_size double")
    out = S.score_series(df, ["subnet_id"], window=W, chunk=7, **args)
    return [r.score for r in out.orderBy("position").collect()]


def frames():
    return [VALUES[i - W + 1 : i + 1] for i in range(W - 1, len(VALUES))]


def test_scores_by_hand(spark):
    z = [0.0 if np.std(f) == 0 else abs(f[-1] - np.mean(f)) / np.std(f) for f in frames()]
    assert scored(spark)[W - 1 :] == pytest.approx(z)
    assert scored(spark)[: W - 1] == [None] * (W - 1)
    off = [np.abs(np.array(f) - np.median(f)) for f in frames()]
    mad = [o[-1] / np.median(o) if np.median(o) > 0 else 0.0 for o in off]
    assert scored(spark, models=["MadDetector"])[W - 1 :] == pytest.approx(mad)
    near = [np.mean(sorted(abs(v - f[-1]) for v in f[:-1])[:3]) for f in frames()]
    assert scored(spark, models=["KNNDetector"])[W - 1 :] == pytest.approx(near)
    both = scored(spark, mode="ensemble", models=["ZScoreDetector", "MadDetector"], ensemble_model="WeightEnsemble", weights=[3, 1])
    assert both[W - 1 :] == pytest.approx([(3 * a + b) / 4 for a, b in zip(z, mad)])
    votes = scored(spark, mode="ensemble", models=["ZScoreDetector", "MadDetector"], ensemble_model="VoteEnsemble", threshold=1.0)
    assert votes[W - 1 :] == [float(a >= 1 and b >= 1) for a, b in zip(z, mad)]


def test_spectral_and_density_scores(spark):
    def saliency(frame):
        s = np.fft.fft(frame)
        log = np.log(np.abs(s) + 1e-8)
        smooth = np.convolve(log, np.ones(3) / 3, mode="same")
        back = np.abs(np.fft.ifft(np.exp(log - smooth + 1j * np.angle(s))))
        return abs(back[-1] - back.mean()) / (back.mean() + 1e-8)

    assert scored(spark, models=["SRDetector"])[W - 1 :] == pytest.approx([saliency(f) for f in frames()])
    first = scored(spark, mode="multivariate", models=["LodaDetector"])
    assert first == scored(spark, mode="multivariate", models=["LodaDetector"])
    assert all(v >= 0 for v in first[W - 1 :])
    flat = VALUES.index(9.0) + 4
    assert first[flat] == 0.0


@pytest.mark.parametrize(
    "mode,models,ensemble",
    [
        ("other", ["ZScoreDetector"], None),
        ("univariate", [], None),
        ("univariate", ["LodaDetector"], None),
        ("multivariate", ["ZScoreDetector"], None),
        ("ensemble", ["ZScoreDetector"], "Other"),
        ("ensemble", ["ZScoreDetector"], None),
    ],
)
def test_unknown_models(mode, models, ensemble):
    with pytest.raises(NotImplementedError):
        S.check_models(mode, models, ensemble)


def test_threshold_of_anomalies_is_strict(spark):
    rows = [("a", 0.5), ("a", 0.4), ("b", 0.6), ("b", None), ("c", 0.5), ("c", 0.5)]
    df = spark.createDataFrame(rows, "batch_id string, score double")
    got = {r.batch_id: r.is_suspicious for r in I.batch_verdicts(df, 0.5, 0.5).collect()}
    assert got == {"a": False, "b": False, "c": True}


def test_own_inspector(spark):
    @I.inspector("even")
    def even(messages, bounds, spec):
        return bounds.select("batch_id", (F.col("part") % 2 == 0).alias("is_suspicious"))

    rows = [("s", f"b{p}", 0, p, at(0), at(0), at(1)) for p in range(3)]
    df = spark.createDataFrame(rows, "subnet_id string, batch_id string, flush_no bigint, part bigint, ts timestamp, begin_ts timestamp, end_ts timestamp")
    got = flow.inspect(df, flow.InspectSpec(inspector="even"))
    assert {r.batch_id for r in got.filter("is_suspicious").collect()} == {"b0", "b2"}
    with pytest.raises(NotImplementedError):
        flow.inspect(df, flow.InspectSpec(inspector="absent"))


def test_positions_run_across_batches(spark):
    bounds = spark.createDataFrame(
        [("s", "b0", 0, 0, 3), ("s", "b1", 0, 1, 2), ("s", "b2", 205, 0, 4), ("t", "c", 1, 0, 1)],
        "subnet_id string, batch_id string, flush_no bigint, part bigint, n_steps bigint",
    )
    steps = bounds.select("batch_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_steps") - 1)).alias("step"))
    slot = F.floor(F.col("flush_no") / 100).cast("bigint")
    out = S.with_positions(steps, bounds, ["subnet_id"], ["flush_no", "part"], slot)
    assert [r.position for r in out.filter("subnet_id = 's'").orderBy("position").collect()] == list(range(1, 10))
    assert out.filter("batch_id = 'b2'").agg(F.min("position")).first()[0] == 6
    ranked = keyed_rank(bounds, ["subnet_id"], slot, [F.col("flush_no"), F.col("part")])
    assert {(r.batch_id, r["rank"]) for r in ranked.collect()} == {("b0", 1), ("b1", 2), ("b2", 3), ("c", 1)}
