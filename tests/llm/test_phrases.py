"""Collocations and quotient filters against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from siltwatch.llm import phrases, quotient
from tests.llm.cases import LOWER, awkward, frame, prose, rows


@pytest.mark.parametrize("n", [1, 2, 5])
def test_filters_lose_nothing(n):
    rng = np.random.default_rng(n)
    for m in (1, 2, 7, 3000):
        grams = rng.integers(0, 40, (m, n)).astype(np.uint64)
        grams[: m // 3] += np.uint64(2**63)
        assert (quotient.restore(quotient.permute(grams)) == grams).all()
        for bits in (0, 1, 5, 20):
            filters = defaultdict(list)
            for half in (grams[: m // 2], grams[m // 2 :]):
                for block, data in quotient.blocks_of(*quotient.summed(quotient.permute(half), np.full(len(half), 300)), bits):
                    filters[block].append(data)
            got = {}
            for block, parts in filters.items():
                spread, counts = quotient.merged(parts, block)
                got.update(zip(map(tuple, quotient.restore(spread).tolist()), counts.tolist(), strict=True))
            assert got == {k: 300 * v for k, v in Counter(map(tuple, grams.tolist())).items()}


@pytest.mark.parametrize("cut", [1, 28, 50])
def test_short_filters_sum_numbers_alike(cut):
    rng = np.random.default_rng(cut)
    first = rng.integers(0, 2**63, 2000, dtype=np.uint64) >> np.uint64(cut) << np.uint64(cut)
    first[::3] = first[0]
    entries = quotient.summed(first[:, None], np.arange(2000))
    got = {}
    for block, data in quotient.blocks_of(*entries, 4, cut):
        spread, counts = quotient.unpack(data, block)
        got.update(zip(spread[:, 0].tolist(), counts.tolist(), strict=True))
    want = Counter()
    for x, c in zip(first.tolist(), range(2000), strict=True):
        want[x] += c
    assert got == want


def test_entries_that_share_their_first_word_stay_apart():
    spread, counts = quotient.summed(np.array([[5, 2], [5, 1], [5, 2], [4, 9]], np.uint64), np.array([1, 1, 1, 7]))
    assert spread.tolist() == [[4, 9], [5, 1], [5, 2]] and counts.tolist() == [7, 1, 2]


def brute(data, least, longest=5, top=2000, percent=100):
    f, n = Counter(), Counter()
    for row in data:
        lang = row[2] if row[2] is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (row[1] or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    often = {g: c for g, c in f.items() if c >= least and len(g[1]) > 1}
    covered = set()
    for (lang, g), c in often.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                if 100 * c >= percent * f[lang, g[i : i + k]]:
                    covered.add((lang, g[i : i + k]))
    best = defaultdict(list)
    for (lang, g), a in often.items():
        if (lang, g) not in covered:
            cuts = [(1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            best[lang].append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    out = []
    for lang, own in best.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def cases():
    rng = random.Random(4)
    texts = ["Red, green: blue! red green blue\tred\x0bgreen blue. A-B a-b É é", "x" * 200_000 + " tail", "a b\nc d", "?!", "ab\xa0cd ab\xa0cd"]
    texts += [prose(rng, 300) + ". the water house ring the water house" for _ in range(20)]
    data = awkward() + rows(texts, start=300)
    data += [(400 + i, "der ring der ring; der Ring", None if i % 2 else "und", "s", "x", "x", "x", "x") for i in range(6)]
    data += [(500 + i, prose(rng, 100, "fr"), "fr", "s", "x", "x", "x", "x") for i in range(6)]
    return data


@pytest.mark.parametrize(("least", "percent", "top"), [(4, 100, 2000), (3, 60, 15)])
def test_collocations(spark, least, percent, top):
    data = cases()
    got = phrases.collocations(frame(spark, data), least, top=top, percent=percent)
    assert sorted(map(tuple, got.collect())) == brute(data, least, top=top, percent=percent)


def test_many_blocks_take_further_merges(spark, monkeypatch):
    monkeypatch.setattr(phrases, "ROUTE_BITS", 3)
    monkeypatch.setattr(phrases, "WAYS", 4)
    monkeypatch.setattr(phrases, "BUFFER", 500)
    data = cases()
    got = phrases.collocations(frame(spark, data).repartition(3), 4, block_bits=7)
    assert sorted(map(tuple, got.collect())) == brute(data, 4)


def test_scores_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, n, left, right = 123_456_789_012_345, 98_765_432_109_876_543, 234_567_890_123_456, 3_456_789_012_345_678
    row = spark.range(1).select(phrases._score(F.lit(a), F.lit(n), F.lit(left), F.lit(right)).alias("s")).first()
    assert row.s == 1000 * a * n // (left * right)


def test_nothing_to_count(spark):
    assert phrases.collocations(frame(spark, [])).count() == 0
    assert phrases.collocations(frame(spark, rows([None, "", " . "])), 1).count() == 0
