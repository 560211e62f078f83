"""Apportionment, targets and takings of the mix."""

from __future__ import annotations

import random

from siltwatch.llm.mixing import MixSpec, mix, sainte_lague
from tests.llm.cases import awkward, frame, prose, words


def brute_targets(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), dict.fromkeys(names, 0.0)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not full:
            return {**target, **{s: weight[s] * level for s in open_}}
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= full
    return target


def check(spark, data, spec=MixSpec()):
    got = mix(frame(spark, data), spec).collect()
    assert len(got) == len(data)
    assert sorted(map(repr, got)) == sorted(map(repr, mix(frame(spark, data[::-1]), spec).collect()))
    sizes, by_id = {}, {}
    for r in data:
        sizes[r[3]] = sizes.get(r[3], 0) + len(words(r[1]))
        by_id[r[0]] = r[3]
    want, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
    for r in got:
        source = by_id[r.doc_id]
        assert r.source_size == sizes[source] and abs(r.target - want[source]) < 1e-6 * (1 + want[source])
        assert 0 <= r.taken <= 3 * r.size
        taken[source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * spec.block_tokens, (s, taken[s], want[s])


def test_mix_of_awkward_rows(spark):
    check(spark, awkward())


def test_mix_with_capped_sources_and_shards(spark):
    rng = random.Random(4)
    data = [(i, prose(rng, rng.randrange(1, 90)), "en", ["a", "b", "c", "d"][0 if i % 5 else i % 4], "", "", "", "") for i in range(300)]
    check(spark, data)
    got = mix(frame(spark, data), MixSpec(shard_tokens=2000)).collect()
    assert sum(r.taken for r in got) > 0 and mix(frame(spark, [])).count() == 0


def test_sainte_lague_is_highest_quotients(spark):
    rng = random.Random(6)
    rows, want = [], {}
    for g in range(12):
        votes = [rng.choice([0, 1, 5, rng.randrange(1, 10_000)]) for _ in range(rng.randrange(1, 9))]
        seats = rng.choice([0, 1, 3, 17, 400])
        rows += [(g, p, v, seats) for p, v in enumerate(votes)]
        quotients = sorted(((-v / (2 * k + 1), p) for p, v in enumerate(votes) if v for k in range(seats)))[:seats]
        want |= {(g, p): sum(q == p for _, q in quotients) for p in range(len(votes))}
    got = sainte_lague(spark.createDataFrame(rows, "g int, p int, v long, s long"), "g", "p", "v", "s").collect()
    assert {(r.g, r.p): r.quota for r in got} == want
