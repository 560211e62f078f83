"""Learned operators: held-out accuracy, planted cases, and brute force where there is one."""

from __future__ import annotations

import math
import pickle
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from siltwatch.llm import decontaminate, langid, quality
from siltwatch.llm.common import bucket
from siltwatch.llm.lm import LmSpec, lm_scores
from siltwatch.llm.trie import BigramTrie, EliasFano, elias_fano
from tests.llm.cases import awkward, fold, frame, prose, rows, words


def test_elias_fano_round_trip():
    rng = np.random.default_rng(2)
    for n, top in ((0, 10), (1, 1), (500, 2**40), (3000, 4000)):
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        own = EliasFano(**elias_fano(values, top))
        assert (own.get(np.arange(n)) == values).all()
        keys = rng.integers(0, top, 200, dtype=np.uint64)
        assert [at >= 0 for at in own.find(keys)] == np.isin(keys, values).tolist()


def test_trie_successors_and_backoff():
    trie = BigramTrie(np.array([3, 9], np.uint64), np.array([-1.0, -2.0]), np.array([0, 0, 1]), np.array([4, 8, 1], np.uint64), np.array([-0.5, -0.25, -3.0]))
    assert trie.successors(3).tolist() == [4, 8] and trie.successors(9).tolist() == [1]
    got = trie.score(np.array([3, 3, 9, 5], np.uint64), np.array([8, 1, 1, 4], np.uint64), np.full(4, -6.0))
    assert got.tolist() == [-0.25, -7.0, -3.0, -6.0]


def test_lm_against_counts(spark):
    rng = random.Random(9)
    data = awkward() + [(i, prose(rng, 50), "en", "s", "", "", "", "") for i in range(200, 240)]
    for spec in (LmSpec(), LmSpec(shard_bytes=2000)):  # the second splits frequent contexts
        got = lm_scores(frame(spark, data), bucket(7) != 2, spec).collect()
        ends = [(r[0], words(r[1]) + ["</s>"]) for r in data]
        train = [w for i, w in ends if fold("" if i is None else i, 7) != 2]
        c, b = Counter(w for ws in train for w in ws), Counter(p for ws in train for p in zip(ws, ws[1:], strict=False))
        total = sum(c.values())
        alone = lambda w: (c[w] + 1) / (total + len(c) + 1)  # noqa: B023, E731
        want = []
        for i, ws in ends:
            after = sum(math.log10((b[p, w] + 20 * alone(w)) / (c[p] + 20)) if c[p] else math.log10(alone(w)) for p, w in zip(ws, ws[1:], strict=False))
            want.append((repr(i), fold("" if i is None else i, 7) == 2, len(ws), sum(c[w] > 0 for w in ws), total, sum(math.log10(alone(w)) for w in ws), math.log10(alone(ws[0])) + after))
        have = sorted((repr(r.doc_id), *r[1:]) for r in got)
        for one, two in zip(have, sorted(want), strict=True):
            assert one[:5] == two[:5] and abs(one[5] - two[5]) < 1e-6 and abs(one[6] - two[6]) <= 0.004 * two[2]
    assert lm_scores(frame(spark, []), bucket(7) != 2).count() == 0


def test_quality_tells_bad_passages(spark):
    rng = random.Random(5)
    data, labels = [], []
    for i in range(500):
        text = prose(rng, rng.randrange(80, 300))
        if bad := i % 4 == 0:
            ws = text.split()
            at = rng.randrange(max(1, len(ws) - 70))
            text = " ".join(w + "###" if at <= k < at + 70 else w for k, w in enumerate(ws))
        data.append((i, text, "en", "s", "", "", "", ""))
        labels.append((i, int(not bad), 0))
    data += [(1000 + (r[0] or 0), *r[1:]) for r in awkward()] + [awkward()[-2]]
    marks = spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, data)
    model = quality.fit(docs, marks, bucket(4) != 2)
    got = quality.quality_scores(docs, model).collect()
    assert len(got) == len(data) and all(0 <= r.quality_score <= 1 for r in got)
    held = [(r.quality_score >= 0.7) == (r.doc_id % 4 != 0) for r in got if r.doc_id is not None and r.doc_id < 500 and fold(r.doc_id, 4) == 2]
    assert len(held) > 80 and sum(held) >= 0.93 * len(held)
    nothing = quality.fit(frame(spark, []), marks.limit(0), bucket(4) != 2)
    assert quality.quality_scores(frame(spark, []), nothing).count() == 0
    assert quality.quality_scores(docs.limit(3), nothing).count() == 3


def test_language_and_und(spark):
    rng = random.Random(7)
    data = [(i, prose(rng, 30, lang), lang, "s", "", "", "", "") for i in range(150) for lang in [["en", "de", "fr"][i % 3]]]
    data += [(900, None, "en", "s", "", "", "", ""), (901, "12 + 3 = !", "en", "s", "", "", "", ""), (902, "", None, None, None, None, None, None)]
    docs = frame(spark, data)
    got = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs, bucket(4) != 2)).collect()}
    held = [got[r[0]].lang_pred == r[2] for r in data[:150] if fold(r[0], 4) == 2]
    assert held and all(held) and all(0 <= r.score <= 1 for r in got.values())
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    none = langid.predict(docs, langid.fit(docs.limit(0), bucket(4) != 2))
    assert {r.lang_pred for r in none.collect()} == {"und"}


def test_forward_sums_all_segmentations():
    listed = list(dict.fromkeys([b" a", b"b", b"ab", b" ab", *[bytes([x]) for x in range(256)]]))
    pieces = langid.Pieces(listed)
    data = np.frombuffer(b"abb a", np.uint8)
    own = langid.distinct_words(np.array([0, 4]), np.array([3, 5]), data)
    chance = np.random.default_rng(3).random((pieces.count, 2))
    lattice = langid.Lattice(pieces, own)
    got = np.exp(lattice.log_chances(chance))[own.place]

    def total(word, k):
        return sum(chance[i, k] * total(word[len(p) :], k) for i, p in enumerate(listed) if word.startswith(p)) if word else 1.0

    for row, word in zip(got, (b" abb", b" a"), strict=True):
        assert np.allclose(row, [total(word, 0), total(word, 1)])
    # Posteriors of the pieces that cover a byte of a word add up to one.
    weight = lattice.expected(chance[:, 0])
    for w, size in enumerate(own.size):
        for at in range(size):
            cover = (lattice.word == w) & (lattice.start <= at) & (lattice.end > at)
            assert np.isclose(weight[cover].sum(), 1)


def test_leaks_with_changed_words(spark):
    rng = random.Random(11)
    items = [(i, prose(random.Random(50 + i), 40) + f". answer{i} is forty{i} two{i}.") for i in range(12)] + [(90, None), (91, "too short"), (92, "")]
    data, want = [], set()
    for i in range(60):
        text = prose(rng, 150).split()
        if i % 5 == 0:
            k = (i // 5) % 12
            own = items[k][1].split()
            for _ in range(3):
                own[rng.randrange(len(own))] = "changed"
            at = rng.randrange(len(text))
            text[at:at] = own
            want.add((i, k))
        data.append((i, " ".join(text).upper() if i % 2 else "\n".join(text), "en", "s", "", "", "", ""))
    docs = frame(spark, data + [(None if r[0] is None else r[0] + 500, *r[1:]) for r in awkward()])
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}
    assert got == want
    kept = {r.doc_id for r in decontaminate.without_leaks(docs, bench).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {i for i, _ in want}
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.without_leaks(docs, bench.limit(0)).count() == docs.count()


def test_long_words_in_chunks_equal_whole_lattice():
    rng = random.Random(18)
    pieces = langid.Pieces(list(dict.fromkeys([b" a", b"ab", b"abcabcabcabcabc", b"bca", *[bytes([x]) for x in range(256)]])))
    text = " ".join(["".join(rng.choice(["abc", "b", "a"]) for _ in range(n)) for n in (300, 1, 2, 3, 40, 100)]).encode()
    ends = [i for i, b in enumerate(text) if b == 32] + [len(text)]
    own = langid.distinct_words(np.array([0, *[e + 1 for e in ends[:-1]]]), np.array(ends), np.frombuffer(text, np.uint8))
    chance = np.random.default_rng(3).random((pieces.count, 2))
    whole = langid.Lattice(pieces, own)
    assert np.allclose(langid.log_chances(pieces, own, chance, places=50), whole.log_chances(chance))
    first = own.data[: own.size[0]]
    weight = whole.expected(chance[:, 0])
    want = np.bincount(whole.piece[whole.word == 0], weights=weight[whole.word == 0], minlength=pieces.count)
    assert np.allclose(langid.long_sums(pieces, first, chance[:, 0], chunk=37), want)
    # A word of 1 MB beside 50,000 ordinary ones leaves lattices within bounds.
    sizes = np.array([1_000_000, *[8] * 50_000])
    many = langid.DistinctWords(np.zeros(sizes.sum(), np.uint8), np.cumsum(sizes) - sizes, sizes, np.arange(len(sizes)))
    split = list(langid.groups(many, 4))
    assert split[0][:2] == (0, 1) and sum(h - l for l, h, _ in split) == len(sizes)  # noqa: E741
    assert all((g.size[0] + 1) * len(g.size) <= langid.PLACES for _, _, g in split[1:])


def brute_leaks(data, items, spec=decontaminate.LeakSpec()):
    """Pairs that leak, from every piece against every passage."""
    out = set()
    for i, text in items:
        for p in decontaminate.pieces_of(i, text or "", spec):
            window = next(w for w in decontaminate.WINDOWS if len(p.words) <= w)
            for doc_id, own, *_ in data:
                near = decontaminate._plain(own or "").tolist()
                for at in range(0, len(near), window // 2):
                    part = near[max(0, at - window // 2) : at + window * 3 // 2]
                    share = decontaminate.common_subsequence(p.masks, len(p.words), part) / len(p.words)
                    told = len(p.answer) > 0 and decontaminate.common_subsequence(p.answer_masks, len(p.answer), part) >= spec.share * len(p.answer)
                    if share >= spec.share or share >= spec.share_with_answer and told:
                        out.add((doc_id, i))
    return out


def test_leaks_of_long_short_and_changed_items(spark):
    rng = random.Random(16)
    vocabulary = [f"w{i}" for i in range(4000)]
    say = lambda n: [vocabulary[min(int(rng.paretovariate(0.6)) - 1, 3999)] if rng.random() < 0.5 else rng.choice(vocabulary) for _ in range(n)]
    own = [say([6, 14, 30, 200, 300][i % 5]) for i in range(60)]
    items = [(i, " ".join(w) + (f". answer is {i} n{i}" if i % 7 == 0 else "")) for i, w in enumerate(own)]
    data = []
    for d in range(90):
        quote = list(own[d % 60])
        if len(quote) > 100 and d % 2:
            at = rng.randrange(len(quote) - 90)
            quote = quote[at : at + 90]
        if d % 3 == 0:
            quote = ["new" if rng.random() < 0.12 else w for w in quote]
        text = say(100)
        at = rng.randrange(100)
        data.append((d, " ".join(text[:at] + quote + text[at:]), "en", "s", "", "", "", ""))
    data += [(500, None, "", "", "", "", "", ""), (501, " ", "", "", "", "", "", "")]
    want = brute_leaks(data, items)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for spec in (decontaminate.LeakSpec(), decontaminate.LeakSpec(dimensions=8)):  # the second holds next to nothing of the items
        got = [(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, data), bench, spec).collect()]
        assert len(want) > 60 and set(got) == want and len(got) == len(want)


def test_latent_dimensions_come_from_all_documents(spark):
    """Words that only one of 2,400 documents has take part; the dimensions are those of the whole matrix."""
    rng = random.Random(18)
    data = [(d, f"own{d} " + " ".join(f"w{min(int(rng.paretovariate(0.8)), 40)}" for _ in range(50)), "", "", "", "", "", "") for d in range(2400)]
    bench = spark.createDataFrame([(0, "w1 w2 w3 w4 w5 w6")], "item_id long, text string")
    docs = frame(spark, data)
    codes = decontaminate.coded(docs)
    idf = decontaminate._inverse_frequencies(codes)
    got = decontaminate.latent_basis(codes, bench, idf, decontaminate.LeakSpec(dimensions=24))
    lines = [(decontaminate._terms(decontaminate._plain(t)), w) for _, t, w in [(i, r[1], 1.0) for i, r in enumerate(data)] + [(0, "w1 w2 w3 w4 w5 w6", 20.0)]]
    held = np.bincount(np.concatenate([np.unique(t) for t, _ in lines[:-1]]), minlength=decontaminate.TERMS)
    assert np.allclose(idf, np.log(2401 / (held + 1)) + 0.01, atol=1e-5)
    used = np.unique(np.concatenate([t for t, _ in lines]))
    assert np.all(np.linalg.norm(got[used], axis=1) > 0)
    matrix = []
    for terms, weight in lines:
        for at in range(0, len(terms), 32):
            own = terms[at : at + 32]
            row = np.bincount(own, weights=idf[own], minlength=decontaminate.TERMS)[used]
            matrix.append(row * weight / np.sqrt((idf[own] ** 2).sum()))
    _, _, true = np.linalg.svd(np.array(matrix), full_matrices=False)
    mine = got[used, :8] / idf[used, None]
    assert np.linalg.norm(true[:8] @ mine) ** 2 > 7.9


def test_sums_of_the_fit_come_from_a_bounded_number_of_tasks(spark):
    """Each task sends a matrix of fixed size, so many small partitions share a task."""
    codes = decontaminate.coded(frame(spark, rows([f"a{i} b c" for i in range(128)])).repartition(64))
    passages = codes.select("terms", "opens", F.lit(1.0).alias("weight")).repartition(64)

    def mark(total, terms, opens, weight, idf):
        total[0, 0] = 1
        total[1, 0] += len(opens)

    got = decontaminate._summed(passages, 1, mark, np.zeros(1, np.float32))
    assert got[1, 0] == 128 and 1 <= got[0, 0] <= spark.sparkContext.defaultParallelism < 64


def test_products_of_rows_equal_dense_ones():
    rng = np.random.default_rng(4)
    idf = pickle.loads(pickle.dumps(rng.random(decontaminate.TERMS).astype(np.float32) + 1))  # as workers get it
    terms = rng.choice(decontaminate.TERMS, 9000).astype(np.uint16) % 700
    opens = np.unique(np.append(0, rng.choice(9000, 400))).astype(np.int32)
    row = np.repeat(np.arange(len(opens)), np.diff(np.append(opens, len(terms))))
    matrix = np.zeros((len(opens), decontaminate.TERMS))
    np.add.at(matrix, (row, terms.astype(int)), idf[terms])
    matrix *= 3 / np.sqrt(np.bincount(row, weights=idf[terms] ** 2))[:, None]
    basis = rng.normal(size=(decontaminate.TERMS, 9)).astype(np.float32)
    total = np.zeros_like(basis)
    decontaminate.add_gram(total, terms, opens, 3.0, idf, basis)
    assert np.allclose(total, matrix.T @ (matrix @ basis), atol=2e-3)
    total = np.zeros_like(basis)
    decontaminate.add_signed(total, terms, opens, 3.0, idf)
    signs = np.linalg.lstsq(matrix.T, total, rcond=None)[0]  # one 1 or -1 in each row
    assert np.allclose(np.abs(signs).max(axis=1), 1, atol=1e-2) and np.allclose(np.abs(signs).sum(axis=1), 1, atol=0.1)


def test_held_words_are_no_fewer_than_a_common_subsequence():
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 3) for _ in range(n))
    pieces = [p for i in range(20) for p in decontaminate.pieces_of(i, say(rng.choice([40, 64, 50])), decontaminate.LeakSpec())]
    near = [decontaminate._plain(say(rng.choice([20, 90, 128])) + (" " + " ".join(["a"] * 30))) [:128] for _ in range(300)]
    hi = np.cumsum([len(n) for n in near])
    lo = hi - [len(n) for n in near]
    passage, piece = np.divmod(np.arange(300 * len(pieces)), len(pieces))
    share = decontaminate.HeldWords(pieces, 64).share(decontaminate._places(np.concatenate(near)), lo, hi, passage, piece)
    for s, p, got in zip(passage.tolist(), piece.tolist(), share.tolist(), strict=True):
        own, held = pieces[p], set(near[s].tolist())
        exact = sum(w in held for w in own.words.tolist()) / len(own.words)
        assert exact <= got <= exact + 0.2
        assert decontaminate.common_subsequence(own.masks, len(own.words), near[s].tolist()) / len(own.words) <= got


def test_subsequence_length():
    masks = {}
    for i, w in enumerate("abcbdab"):
        masks[ord(w)] = masks.get(ord(w), 0) | 1 << i
    assert decontaminate.common_subsequence(masks, 7, [ord(c) for c in "bdcaba"]) == 4
    assert quality.passages(pa.array(["", None, "a b"]))[1].tolist() == [0, 1, 2, 3]
