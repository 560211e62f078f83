"""Exact and near duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from siltwatch.llm.components import components
from siltwatch.llm.exact_dedup import exact_duplicates
from siltwatch.llm.minhash import near_duplicates, signature
from tests.llm.cases import awkward, frame, prose, rows, words


def test_exact_groups(spark):
    data = awkward()
    got = exact_duplicates(frame(spark, data)).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for r in data:
        groups[norm(r[1])].append(r[0])
    want = []
    for r in data:
        ids = groups[norm(r[1])]
        keep = min((i for i in ids if i is not None), default=None)
        want.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256(norm(r[1]).encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_exact_empty_table(spark):
    assert exact_duplicates(frame(spark, [])).count() == 0


def brute_components(data, n, percent=80):
    sets = {}
    for r in data:
        if r[0] is not None:
            w = words(r[1])
            sets[r[0]] = {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i), top(i) == i) for i in ids}


def near_cases():
    rng = random.Random(8)
    texts = []
    for _ in range(6):  # chains: each copy a little further from the first
        own = prose(rng, 120).split()
        for _ in range(12):
            texts.append(" ".join(own))
            own[rng.randrange(len(own))] = f"w{rng.random()}"
    return awkward() + rows(texts, start=200)


def test_near_components(spark):
    data = near_cases()
    got = near_duplicates(frame(spark, data), words=4).collect()
    want = brute_components(data, 4)
    assert len(got) == len(data)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == want[r.doc_id], r
    assert near_duplicates(frame(spark, [])).count() == 0


def test_prefix_rows_only_where_another_component_meets(spark, monkeypatch):
    """400 sets that share nothing and 40 that come in pairs, with counters too few to tell single shingles."""
    import numpy as np

    from siltwatch.llm import prefixes

    monkeypatch.setattr(prefixes, "CELL_BITS", 6)
    rng = np.random.default_rng(19)
    sets = [np.sort(rng.integers(0, 2**64, 100, dtype=np.uint64)) for _ in range(420)]
    for own in sets[400:]:
        sets.append(np.sort(np.concatenate([own[5:], rng.integers(0, 2**64, 3, dtype=np.uint64)])))
    made = spark.createDataFrame([(i, bytearray(own.tobytes())) for i, own in enumerate(sets)], "id long, own binary").repartition(3)
    sides = spark.createDataFrame([(i, i, True) for i in range(len(sets))], "id long, component long, odd boolean")
    counts = prefixes.cell_counts(made)
    pairs = sorted(tuple(r) for r in prefixes.near_pairs(made, sides, counts, 80).collect())
    assert pairs == [(400 + i, 420 + i) for i in range(20)]
    members = made.join(sides, "id")
    shared = prefixes.shared_keys(members, counts, 80)
    columns = "s long, cx long, cy long, id long, n long, left long"
    rows = members.select("id", "own").mapInArrow(prefixes._rows(counts, shared, 80, True), columns).groupBy("id").count().collect()
    assert {r.id for r in rows if r["count"] > 3} == set(range(400, 440)) and len(rows) < 60
    same = sides.withColumn("component", F.lit(7))  # what is linked already meets nobody
    linked = prefixes.shared_keys(made.join(same, "id"), counts, 80)
    assert made.mapInArrow(prefixes._rows(counts, linked, 80, True), columns).count() == 0


def test_circulant_signature_estimates_jaccard():
    import numpy as np

    rng = np.random.default_rng(1)
    both = rng.integers(0, 2**63, 900, dtype=np.uint64)
    a, b = (np.concatenate([both, rng.integers(0, 2**63, 100, dtype=np.uint64)]) for _ in range(2))
    assert abs((signature(a) == signature(b)).mean() - 900 / 1100) < 0.12


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).agg(F.count("*")).first()[0] == 0
