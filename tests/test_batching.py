from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from siltwatch.operators import batching as B
from siltwatch.operators.ranking import keyed_offset, keyed_rank, time_slot, trailing_frames

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def lines(spark, rows):
    made = [(i, key, START + dt.timedelta(seconds=s)) for i, (key, s) in enumerate(rows)]
    return spark.createDataFrame(made, "logline_id bigint, subnet_id string, ts timestamp")


def random_rows(n, seed, span=400, hot=0.6):
    rng = random.Random(seed)
    return [("hot" if rng.random() < hot else f"k{rng.randrange(5)}", round(rng.random() * span, 3)) for _ in range(n)]


def simulate(rows, size, seconds):
    """Add lines in time order, send on size, flush every key at each window end."""
    batch, buffer, sent = {}, {}, []

    def complete(key):
        if batch.get(key):
            sent.append((key, tuple(buffer.get(key, ())), tuple(batch[key])))
            buffer[key] = batch.pop(key)
        else:
            buffer.pop(key, None)

    def flush():
        for key in set(batch) | set(buffer):
            complete(key)

    window = None
    for i, (key, s) in sorted(enumerate(rows), key=lambda e: (e[1][1], e[0])):
        w = int(s // seconds)
        if window is not None:
            for _ in range(min(w - window, 3)):
                flush()
        window = w
        batch.setdefault(key, []).append(i)
        if len(batch[key]) >= size:
            complete(key)
    flush()
    return sorted(sent)


def collected(sent):
    groups = {}
    for r in sent.orderBy("batch_id", "position").collect():
        groups.setdefault((r.subnet_id, r.batch_id), []).append((r.is_buffer, r.logline_id))
    return sorted(
        (key, tuple(i for b, i in g if b), tuple(i for b, i in g if not b)) for (key, _), g in groups.items()
    )


@pytest.mark.parametrize("size,seconds,slot", [(5, 30, 300), (7, 60, 10), (1, 50, 300), (50, 400, 20), (4, 10, 300)])
def test_batches_match_a_line_by_line_simulation(spark, size, seconds, slot):
    rows = random_rows(400, seed=size)
    spec = B.BatchSpec(size=size, seconds=seconds, slot_seconds=slot)
    assigned = B.assign_batches(lines(spark, rows), spec)
    assert collected(B.carry_over(assigned, spec)) == simulate(rows, size, seconds)


def test_bounds_agree_with_rows(spark):
    spec = B.BatchSpec(size=6, seconds=40)
    assigned = B.assign_batches(lines(spark, random_rows(300, 3)), spec)
    rows = B.carry_over(assigned, spec).groupBy("batch_id").agg(
        F.first("begin_ts"), F.first("end_ts"), F.count_if("is_buffer"), F.count_if(~F.col("is_buffer"))
    )
    bounds = B.batch_bounds(assigned, spec).select("batch_id", "begin_ts", "end_ts", "n_buffer", "n_new")
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, bounds.collect()))


def test_full_batch_before_a_flush_expires(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 31.0)]
    spec = B.BatchSpec(size=2, seconds=30)
    assert collected(B.carry_over(B.assign_batches(lines(spark, rows), spec), spec)) == [("a", (), (0, 1)), ("a", (), (2,))]
    spec = B.BatchSpec(size=3, seconds=30)
    assert collected(B.carry_over(B.assign_batches(lines(spark, rows), spec), spec)) == [("a", (), (0, 1)), ("a", (0, 1), (2,))]


def test_settings_merge_is_shallow():
    merged = B.merge_settings(B.DEFAULTS, {"subnet_id": {"ipv4_prefix_length": 16}, "batch_size": 5})
    assert merged["subnet_id"] == {"ipv4_prefix_length": 16}
    assert B.BatchSpec.from_settings(merged).size == 5
    assert B.merge_settings(B.DEFAULTS, None) == B.DEFAULTS


def test_envelope_keeps_order(spark):
    spec = B.BatchSpec(size=3, seconds=30)
    sent = B.carry_over(B.assign_batches(lines(spark, [("a", 3.0), ("a", 1.0), ("a", 31.0)]), spec), spec)
    got = {r.batch_id: [x.logline_id for x in r.data] for r in B.batch_envelopes(sent, ["logline_id"]).collect()}
    assert sorted(got.values()) == [[1, 0], [1, 0, 2]]


@pytest.mark.parametrize("slot", [1, 30, 10_000])
def test_rank_and_offset_of_a_hot_key(spark, slot):
    rows = random_rows(500, 9, hot=0.9)
    df = lines(spark, rows).withColumn("w", (F.col("logline_id") % 3).cast("bigint"))
    order = [F.col("ts"), F.col("logline_id")]
    out = keyed_rank(df, ["subnet_id"], time_slot(F.col("ts"), slot), order, total="size")
    out = keyed_offset(out, ["subnet_id"], time_slot(F.col("ts"), slot), order, "w", "before")
    seen, total = {}, {}
    for r in sorted(out.collect(), key=lambda r: (r.ts, r.logline_id)):
        seen[r.subnet_id] = seen.get(r.subnet_id, 0) + 1
        assert r["rank"] == seen[r.subnet_id]
        assert r["before"] == total.get(r.subnet_id, 0)
        total[r.subnet_id] = total.get(r.subnet_id, 0) + r.w
    assert {r.subnet_id: r["size"] for r in out.collect()} == seen


@pytest.mark.parametrize("chunk", [10, 17, 1000])
def test_trailing_frames_cross_chunks(spark, chunk):
    df = lines(spark, random_rows(300, 4))
    ranked = keyed_rank(df, ["subnet_id"], time_slot(F.col("ts"), 20), [F.col("ts"), F.col("logline_id")])
    framed = trailing_frames(ranked, ["subnet_id"], "rank", lambda over: {"ids": over(F.collect_list("logline_id"))}, 10, chunk)
    rows = framed.collect()
    assert len(rows) == 300
    by_key = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        by_key.setdefault(r.subnet_id, []).append(r.logline_id)
        assert r.ids == by_key[r.subnet_id][-10:]
