"""Merkle manifest, row numbers and shards against plain loops."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltwatch.llm import merkle, sharding
from siltwatch.llm.numbering import numbered
from tests.llm.cases import awkward, frame, rows

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, row string, i long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(row: list[str]) -> list[list[str]]:
    levels = [row]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([sha("".join(now[i : i + 3])) for i in range(0, len(now), 3)])
    return levels


def path(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    out = []
    for row in levels[:-1]:
        run = i - i % 3
        out.append(("".join(row[run:i]), "".join(row[i + 1 : run + 3])))
        i //= 3
    return out


def brute(data):
    groups = defaultdict(list)
    for r in data:
        own = r[:5]
        other = None
        if own[0] is not None and zlib.crc32(str(own[0]).encode()) % 2 == 0 and own[4] is not None:
            other = leaf(*own[:4], own[4].replace("\n", ""))
        groups[own[1]].append(((own[0] is not None, own[0] or 0), leaf(*own), other, own[0]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [climb([x[1] for x in sorted(groups[s], key=lambda x: (x[0], x[1]))]) for s in order]
    top = climb([t[-1][0] for t in trees])
    out = []
    for no, s in enumerate(order):
        for i, (_, own, other, doc_id) in enumerate(sorted(groups[s], key=lambda x: (x[0], x[1]))):
            whole = path(trees[no], i) + path(top, no)
            now = other or own
            for x, y in whole:
                now = sha(x + now + y)
            root = top[-1][0]
            out.append((doc_id, own, trees[no][-1][0], root, sha("".join(x + y for x, y in whole)), now, now == root))
    return out


def dataset(n: int, seed: int = 5):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        text = rng.choice([None, "", "a\nb", "plain", "ü\n\n", "x" * rng.randrange(50)])
        source = rng.choice(["hot"] * 5 + ["ä", "b", None, "", f"s{rng.randrange(6)}"])
        data.append((rng.choice([i, i, i, None, 3]), source, rng.choice(["en", None]), rng.choice([1, None, -4]), text, "x", "x", 7))
    return [*data, data[0], data[0], (10**12, "lone", None, None, "z" * 300_000 + "\n", "x", "x", 7)]


def frame_of(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize(("steps", "n"), [(6, 40), (1, 200), (2, 120)])
def test_proofs(spark, steps, n):
    """Small blocks make many rounds."""
    data = dataset(n)
    got = merkle.tampered_proofs(frame_of(spark, data), steps).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(data)))
    assert {r.verified for r in got} == {True, False}


def test_proofs_of_small_tables(spark):
    assert merkle.tampered_proofs(frame_of(spark, [])).count() == 0
    one = [(4, None, None, None, None, "x", "x", 7)]
    assert [tuple(r) for r in merkle.tampered_proofs(frame_of(spark, one)).collect()] == brute(one)


def test_layout_is_a_bijection_and_recursive():
    for levels in range(1, 8):
        where = np.concatenate([merkle.address(levels, d, np.arange(3**d)) for d in range(levels)])
        assert sorted(where.tolist()) == list(range(merkle.tree_size(levels)))
    # Four levels: a tree of two on top, then nine of two, each in one stretch.
    assert merkle.address(4, 0, np.arange(1)).tolist() == [0]
    assert merkle.address(4, 1, np.arange(3)).tolist() == [1, 2, 3]
    assert merkle.address(4, 2, np.arange(9)).tolist() == list(range(4, 40, 4))
    assert merkle.address(4, 3, np.arange(6)).tolist() == [5, 6, 7, 9, 10, 11]


def test_numbering_orders_everything_and_splits_ties(spark):
    data = [(i % 7 if i % 3 else None, "hot") for i in range(500)] + [(3, "hot")] * 400
    df = spark.createDataFrame(data, "a long, b string").repartition(5)
    got = sorted((r.at, r.a) for r in numbered(df, ("a",), "at").collect())
    assert [i for i, _ in got] == list(range(900))
    assert [a for _, a in got] == sorted((a for a, _ in data), key=lambda a: (a is not None, a or 0))
    assert numbered(df.limit(0), ("a",), "at").count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 65_537])
def test_feistel_is_a_bijection_with_an_inverse(n):
    numbers = np.arange(n)
    places = sharding.permuted(numbers, n, 13)
    assert sorted(places.tolist()) == numbers.tolist()
    assert (sharding.restored(places, n, 13) == numbers).all()
    if n >= 1000:
        assert (sharding.permuted(numbers, n, 14) != places).mean() > 0.9
        assert abs(np.corrcoef(numbers, places)[0, 1]) < 0.1


def test_shards(spark):
    data = awkward() + rows(["same"] * 150, start=2000) + [(9, "same", *["x"] * 6)] * 100
    docs = frame(spark, data)
    got = sharding.sharded(docs).collect()
    assert len(got) == len(data) and {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    keys = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in data)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == keys
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    again = sharding.sharded(docs.repartition(7)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, again)))
    order = sorted(keys.elements(), key=lambda k: (k[0] is not None, k[0] or 0, *k[1:]))
    for r in got:
        assert order[sharding.row_number(r.shard, r.slot, len(data), 16, 13)] == (r.doc_id, r.size, r.text_crc32)
    assert sharding.sharded(frame(spark, [])).count() == 0


def test_written_shards_hold_whole_rows(spark, tmp_path):
    docs = frame(spark, awkward()).withColumn("shard", F.lit("own")).withColumn("slot", F.lit("own"))
    sharding.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    keep = [c for c in docs.columns if c not in ("shard", "slot")]
    assert sorted(map(repr, back.select(*keep).collect())) == sorted(map(repr, docs.select(*keep).collect()))
    placed = sorted((r.shard, r.slot, str(r.doc_id)) for r in back.collect())
    assert placed == sorted((r.shard, r.slot, str(r.doc_id)) for r in sharding.sharded(docs, 4).collect())
