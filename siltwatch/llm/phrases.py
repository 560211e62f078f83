"""Collocations: phrases whose words keep together, per language.

Texts are counted in passes: words, then pairs of frequent words, then phrases of three
to five words all of whose pairs are frequent. Pairs and phrases are first counted by
shortened numbers, whose sums can only be too high, and then exactly where those reach
the least count. A phrase that reaches it has only parts that do, so nothing that counts
is lost. What is frequent travels to the next pass as a bitmap of fixed size: a stray
hit costs a counter, never a wrong result. Counters are counting quotient filters
(``quotient``), merged block by block.

A word's id is a 64-bit hash; no two words may share the id of a frequent one, which is
checked on the words themselves.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwatch.llm.bitmaps import PLACE_BITS, bitmap, has
from siltwatch.llm.common import staged
from siltwatch.llm.quotient import blocks_of, merged, permute, restore, summed
from siltwatch.llm.words import Texts, mix, slices, texts_of, words_of

LONGEST = 5
MAP_BITS = 27
"""Most bits of the number of a bitmap's places: 16 MB, whatever the input."""
BUFFER = 200_000
"""Entries that a task gathers of a language and length before it packs them."""
BLOCK_BYTES = 8 << 20
SPARE_BITS = 8
"""Bits of a shortened number beyond those that count all words."""
ROUTE_BITS = 10
"""Blocks are told apart by so many bits at a time; more bits take one more merge."""
WAYS = 64
"""Filters of a block that one task merges in a merge that is not the last, in the mean."""

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(10, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

FILTERS = "lang string, n int, block long, salt int, filter binary"
NAME_BITS = 6
"""Words are named in 64 groups of ids."""
GRAMS = "lang string, ids array<bigint>, f bigint, place bigint"


def _places(ids: np.ndarray, lang: str) -> np.ndarray:
    """Place of each n-gram (row of ids) of a language in a bitmap."""
    out = np.full(len(ids), zlib.crc32(lang.encode()), dtype=np.uint64)
    for i in range(ids.shape[1]):
        out = mix(out ^ (ids[:, i] + np.uint64(i + 1)))
    return (out >> np.uint64(64 - PLACE_BITS)).astype(np.int64)


def _short_places(first: np.ndarray, cut: int, lang: str, n: int) -> np.ndarray:
    """Place of shortened numbers (upper bits of ``first``) of a language and length in a bitmap."""
    out = mix((first >> np.uint64(cut)) ^ (np.uint64(zlib.crc32(f"{n} {lang}".encode())) << np.uint64(32)))
    return (out >> np.uint64(64 - PLACE_BITS)).astype(np.int64)


def _tokens(texts: Texts):
    """Words of a slice, and for each word whether the next one follows in the same piece."""
    breaks = _BREAK[texts.data]
    words = words_of(Texts(np.where(breaks, np.uint8(32), texts.data), texts.offsets))
    seen = np.cumsum(breaks)
    follows = np.zeros(len(words.hash), dtype=bool)
    if len(words.hash) > 1:
        follows[:-1] = (words.row[1:] == words.row[:-1]) & (seen[words.start[1:]] == seen[words.end[:-1] - 1])
    return words, follows


def _grams(hashes: np.ndarray, follows: np.ndarray, n: int) -> np.ndarray:
    """All n-grams within pieces; ``follows[i]`` says that words i and i + 1 may stand in one."""
    inside = np.ones(max(0, len(hashes) - n + 1), dtype=bool)
    for j in range(n - 1):
        inside &= follows[j : j + len(inside)]
    at = np.flatnonzero(inside)
    return np.stack([hashes[at + j] for j in range(n)], axis=1)


class _Gatherer:
    """Counts of a task, packed as filters whenever a buffer is full."""

    def __init__(self, bits: int, salts: int, buffer: int, cut: int):
        self.bits, self.salts, self.buffer, self.cut, self.parts, self.held, self.packed = bits, salts, buffer, cut, {}, {}, 0

    def add(self, lang: str, n: int, grams: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(grams):
            spread = permute(grams)
            if self.cut:
                spread = spread[:, :1] >> np.uint64(self.cut) << np.uint64(self.cut)
            entries = summed(spread, np.ones(len(grams), dtype=np.int64))
            self.parts.setdefault((lang, n), []).append(entries)
            self.held[lang, n] = self.held.get((lang, n), 0) + len(entries[0])
            if self.held[lang, n] > self.buffer:
                yield from self.pack(lang, n)

    def pack(self, lang: str, n: int) -> Iterator[pa.RecordBatch]:
        parts = self.parts.pop((lang, n))
        self.held[lang, n] = 0
        entries = summed(np.concatenate([s for s, _ in parts]), np.concatenate([c for _, c in parts]))
        self.packed += 1
        salt = zlib.crc32(f"{lang}/{n}/{self.packed}".encode()) % self.salts
        yield _filter_rows(lang, n, blocks_of(*entries, self.bits, self.cut), salt)

    def rest(self) -> Iterator[pa.RecordBatch]:
        for lang, n in list(self.parts):
            yield from self.pack(lang, n)


def _filter_rows(lang: str, n: int, blocks: list[tuple[int, bytes]], salt: int) -> pa.RecordBatch:
    k = len(blocks)
    return pa.record_batch(
        {
            "lang": pa.array([lang] * k, pa.string()),
            "n": pa.array([n] * k, pa.int32()),
            "block": pa.array([b for b, _ in blocks], pa.int64()),
            "salt": pa.array([salt] * k, pa.int32()),
            "filter": pa.array([f for _, f in blocks], pa.binary()),
        }
    )


def _packed_words(ids: np.ndarray, words: list[bytes]) -> bytes:
    """Ids and words of one group."""
    sizes = np.array([len(w) for w in words], dtype="<u4")
    return b"".join([len(ids).to_bytes(8, "little"), ids.astype("<u8").tobytes(), sizes.tobytes(), *words])


def _named_words(key: tuple, rows: pa.Table) -> pa.Table:
    """Distinct (id, word) of one group."""
    seen = set()
    for data in rows.column("filter").to_pylist():
        k = int.from_bytes(data[:8], "little")
        ids = np.frombuffer(data, dtype="<u8", count=k, offset=8).astype(np.uint64).view(np.int64)
        ends = np.cumsum(np.frombuffer(data, dtype="<u4", count=k, offset=8 + 8 * k)).astype(np.int64) + 8 + 12 * k
        starts = np.append(8 + 12 * k, ends[:-1])
        seen.update((i, data[a:b]) for i, a, b in zip(ids.tolist(), starts.tolist(), ends.tolist(), strict=True))
    return pa.table({"id": pa.array([i for i, _ in seen], pa.int64()), "word": pa.array([w.decode("utf-8", "replace") for _, w in seen], pa.string())})


def _by_language(part: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    langs = part.column("lang").dictionary_encode()
    codes = langs.indices.to_numpy(zero_copy_only=False)
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        yield lang, part.filter(pa.array(codes == code))


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of two columns in order, and where each occurs first."""
    order = np.lexsort((rows[:, 1], rows[:, 0]))
    ordered = rows[order]
    new = np.append(True, (ordered[1:] != ordered[:-1]).any(axis=1))
    return ordered[new], order[new]


_CHECK = np.random.default_rng(12).integers(1, 2**63, 256, dtype=np.uint64)[_LOWER]


class _Namer:
    """Words of a task by id, packed by groups of ids.

    Every occurrence of an id is compared by a second sum over its bytes; where that
    differs, the word is told as well, so that the owner of the id sees two.
    """

    def __init__(self, limit: int = 200_000):
        self.limit = limit
        self.ids, self.sums, self.words = np.zeros(0, np.uint64), np.zeros(0, np.uint64), []

    def add(self, texts: Texts, words, good: np.ndarray) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(texts.data) + 1, dtype=np.uint64)
        np.cumsum(_CHECK[texts.data], out=total[1:])
        at = np.flatnonzero(good)
        both = np.stack([words.hash[at], total[words.end[at]] - total[words.start[at]]], axis=1)
        entries, first = _distinct(both) if len(both) else (both, at)
        where = np.searchsorted(self.ids, entries[:, 0])
        near = np.minimum(where, max(0, len(self.ids) - 1))
        old = (self.ids[near] == entries[:, 0]) & (self.sums[near] == entries[:, 1]) if len(self.ids) else np.zeros(len(entries), bool)
        new, chosen = entries[~old], at[first[~old]]
        if len(new):
            lower = _LOWER[texts.data]
            cuts = zip(words.start[chosen].tolist(), words.end[chosen].tolist(), strict=True)
            self.words += [(i, lower[a:b].tobytes()) for i, (a, b) in zip(new[:, 0].tolist(), cuts, strict=True)]
            ids, sums = np.concatenate([self.ids, new[:, 0]]), np.concatenate([self.sums, new[:, 1]])
            order = np.argsort(ids, kind="stable")
            self.ids, self.sums = ids[order], sums[order]
        if len(self.words) > self.limit:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        groups: dict[int, list[tuple[int, bytes]]] = {}
        for i, word in self.words:
            groups.setdefault(i >> (64 - NAME_BITS), []).append((i, word))
        for group, own in groups.items():
            yield self._row(group, [i for i, _ in own], [w for _, w in own])
        self.words = []
        if len(self.ids) > self.limit:
            self.ids, self.sums = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    @staticmethod
    def _row(group: int, ids: list[int], words: list[bytes]) -> pa.RecordBatch:
        return _filter_rows("", 0, [(group, _packed_words(np.array(ids, dtype=np.uint64), words))], 0)


def _count(lengths: tuple[int, ...], known: np.ndarray | None, pairs: bool, short: np.ndarray | None, short_cut: int, name: bool,
           bits: int, salts: int, buffer: int, cut: int):
    """Filters of the n-grams of some lengths.

    ``known`` is a bitmap of words, or of ``pairs``, that an n-gram must consist of;
    ``short`` one of the shortened numbers it must have itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, named = _Gatherer(bits, salts, buffer, cut), _Namer()
        for part in slices(batches):
            for lang, rows in _by_language(part):
                texts = texts_of(rows.column("text"))
                words, follows = _tokens(texts)
                if not len(words.hash):
                    continue
                if pairs:
                    both = np.stack([words.hash[:-1], words.hash[1:]], axis=1)
                    follows[:-1] &= has(known, _places(both, lang))
                elif known is not None:
                    good = has(known, _places(words.hash[:, None], lang))
                    follows[:-1] &= good[:-1] & good[1:]
                    if name:
                        yield from named.add(texts, words, good)
                for n in lengths:
                    grams = _grams(words.hash, follows, n)
                    if short is not None and len(grams):
                        grams = grams[has(short, _short_places(permute(grams)[:, 0], short_cut, lang, n))]
                    yield from gathered.add(lang, n, grams)
        yield from gathered.rest()
        yield from named.rest()

    return run


def _merge(finer: int, cut: int):
    """Filters of one block made finer ones."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        entries = merged(rows.column("filter").to_pylist(), key[2].as_py())
        salt = key[3].as_py()
        return pa.Table.from_batches([_filter_rows(key[0].as_py(), key[1].as_py(), blocks_of(*entries, finer, cut), salt)])

    return run


def _frequent(least: int, cut: int):
    """Entries of one block that reach the least count, and the sum over the block (no ids).

    Shortened numbers have a place only.
    """

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        lang = key[0].as_py()
        spread, counts = merged(rows.column("filter").to_pylist(), key[2].as_py())
        often = counts >= least
        ids = restore(spread[often])
        places = _short_places(ids[:, 0], cut, lang, key[1].as_py()) if cut else _places(ids, lang)
        k = len(ids)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(k + 1, dtype=np.int32) * ids.shape[1]), pa.array(ids.ravel().view(np.int64)))
        lists = pa.concat_arrays([lists, pa.array([[]], pa.list_(pa.int64()))])
        return pa.table(
            {
                "lang": pa.array([lang] * (k + 1), pa.string()),
                "ids": lists,
                "f": pa.array([*counts[often].tolist(), int(counts.sum())], pa.int64()),
                "place": pa.array([*places.tolist(), -1], pa.int64()),
            }
        )

    return run


@dataclass
class _Pass:
    """One pass over the texts: what it counts, and what n-grams must hold."""

    lengths: tuple[int, ...]
    known: Broadcast | None = None
    pairs: bool = False
    short: Broadcast | None = None
    short_cut: int = 0
    name: bool = False
    cut: int = 0

    def counted(self, docs: DataFrame, least: int, bits: int) -> tuple[DataFrame, DataFrame]:
        """Frequent n-grams (and totals by block), and the words named on the way."""
        route = [*range(ROUTE_BITS, bits, ROUTE_BITS), bits]
        salts = 1 if len(route) == 1 else max(1, (1 << bits) // WAYS)
        settings = (route[0], salts, BUFFER, self.cut)
        lengths, known, pairs, short, short_cut, name = self.lengths, self.known, self.pairs, self.short, self.short_cut, self.name

        def count(batches):
            maps = [b.value if b else None for b in (known, short)]
            return _count(lengths, maps[0], pairs, maps[1], short_cut, name, *settings)(batches)

        made = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(count, FILTERS)
        if name:  # two readers
            made = staged(made, "filters")
        filters = made.where("n > 0")
        for now, finer in zip(route, route[1:], strict=False):
            filters = filters.groupBy("lang", "n", "block", "salt").applyInArrow(_merge(finer, self.cut), FILTERS)
            salts = max(1, salts >> (finer - now))
            filters = filters.withColumn("salt", F.expr(f"cast(salt % {salts} AS int)"))
        grams = staged(filters.groupBy("lang", "n", "block").applyInArrow(_frequent(least, self.cut), GRAMS), "grams")
        return grams, made.where("n = 0").groupBy("block").applyInArrow(_named_words, "id long, word string")


def _map_of(grams: DataFrame) -> Broadcast:
    """Bitmap of frequent n-grams, 2 ** MAP_BITS bits at most."""
    found = bitmap(grams.where("size(ids) > 0"), "place", MAP_BITS)
    return grams.sparkSession.sparkContext.broadcast(found)


def counts(docs: DataFrame, least: int = 100, longest: int = LONGEST, block_bits: int | None = None):
    """Frequent phrases of one to ``longest`` words with their counts, totals by language, and words by id."""
    docs = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    if block_bits is None:  # a block's filters should fit a task
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        block_bits = min(30, max(4, (size // BLOCK_BYTES).bit_length()))
    count = lambda step: step.counted(docs, least, block_bits)
    ones, _ = count(_Pass((1,)))
    totals = staged(ones.where("size(ids) = 0").groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    tokens = totals.agg(F.max("n")).first()[0] or 0
    cut = max(1, 64 - max(tokens.bit_length() + SPARE_BITS, block_bits + 8))
    words_map = _map_of(ones)
    likely, _ = count(_Pass((2,), words_map, cut=cut))
    pairs, words = count(_Pass((2,), words_map, short=_map_of(likely), short_cut=cut, name=True))
    grams = ones.unionByName(pairs)
    if longest > 2:
        more, pairs_map = tuple(range(3, longest + 1)), _map_of(pairs)
        likely, _ = count(_Pass(more, pairs_map, pairs=True, cut=cut))
        phrases, _ = count(_Pass(more, pairs_map, pairs=True, short=_map_of(likely), short_cut=cut))
        grams = grams.unionByName(phrases)
    words = staged(words, "words")
    twice = words.groupBy("id").count().where("count > 1")
    shared = twice.join(ones.where("size(ids) > 0").select(F.element_at("ids", 1).alias("id")), "id", "left_semi")
    if not shared.isEmpty():
        raise ValueError("two words share a 64-bit id that is frequent; change the seed of word hashes")
    return staged(grams.where("size(ids) > 0").select("lang", "ids", "f"), "phrases"), totals, words


def _score(a: Column, n: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000 * a * n / (l * r)), exact: products stay within 38 digits up to a = 10 ** 15, n = 10 ** 17."""
    top = (F.lit(1000).cast("decimal(4,0)") * a.cast("decimal(15,0)")) * n.cast("decimal(17,0)")
    low = l.cast("decimal(17,0)") * r.cast("decimal(17,0)")
    return F.call_function("div", top, low)


def collocations(docs: DataFrame, least: int = 100, longest: int = LONGEST, top: int = 2000, percent: int = 100, block_bits: int | None = None) -> DataFrame:
    """Best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Words are blank-separated with A-Z in lower case, inside pieces between
    ``. , ; : ! ?`` and line ends. A phrase of 2 to ``longest`` words counts ``a`` times
    (``least`` at least); it is cut where ``floor(1000 * a * n / (l * r))`` is lowest,
    ties at the earliest place, with ``l`` and ``r`` the counts of its parts and ``n``
    all words of the language. Phrases inside a longer one that has ``percent`` of
    their count are dropped. The first ``top`` of each language are returned by score,
    count and phrase (UTF-8 bytes).

    A null lang is ``und`` and joins rows that say so; null and empty texts have no
    words; repeated rows count as often as they occur; doc_id and other columns are
    ignored; an empty table gives no rows.
    """
    grams, totals, words = counts(docs, least, longest, block_bits)
    found = grams.where("size(ids) > 1").withColumnRenamed("f", "a")
    inner = F.expr(
        "flatten(transform(sequence(2, size(ids) - 1), k -> transform(sequence(1, size(ids) - k + 1), i -> slice(ids, i, k))))"
    )
    parts = found.where("size(ids) > 2").select("lang", F.explode(F.array_distinct(inner)).alias("ids"), F.col("a").alias("outer"))
    parts = parts.groupBy("lang", "ids").agg(F.max("outer").alias("outer"))
    kept = found.join(parts, ["lang", "ids"], "left").where(f"outer IS NULL OR 100 * outer < {percent} * a").drop("outer")
    kept = staged(kept, "candidates")
    cuts = kept.select("lang", "ids", "a", F.explode(F.expr("sequence(1, size(ids) - 1)")).alias("k"))
    left = grams.select("lang", F.col("ids").alias("head"), F.col("f").alias("l"))
    right = grams.select("lang", F.col("ids").alias("tail"), F.col("f").alias("r"))
    cuts = cuts.withColumn("head", F.expr("slice(ids, 1, k)")).withColumn("tail", F.expr("slice(ids, k + 1, size(ids) - k)"))
    cuts = cuts.join(left, ["lang", "head"]).join(right, ["lang", "tail"]).join(totals, "lang")
    cuts = cuts.withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    best = cuts.groupBy("lang", "ids", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spelled = kept.select("lang", "ids", F.posexplode("ids").alias("at", "id")).join(words, "id")
    spelled = spelled.groupBy("lang", "ids").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
    spelled = spelled.select("lang", "ids", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase"))
    scored = best.join(spelled, ["lang", "ids"]).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rank = lambda *keys: F.row_number().over(Window.partitionBy("lang", *keys).orderBy(*order))
    some = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    some = some.withColumn("rank", rank("part")).where(F.col("rank") <= top).drop("part", "rank")
    out = some.withColumn("rank", rank().cast("long")).where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def sql(least: int = 100, longest: int = LONGEST, top: int = 2000, percent: int = 100) -> str:
    """SQL twin over ``documents``: all n-grams counted as lists of words."""
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
),
spoken AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, ws, count(*) AS f FROM (
    SELECT lang, unnest(list_transform(range(1, len(w) - s.k + 2), lambda i: w[i : i + s.k - 1])) AS ws
    FROM spoken, (SELECT unnest(range(1, {longest + 1})) AS k) s WHERE len(w) >= s.k
  ) GROUP BY lang, ws
),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM spoken GROUP BY lang),
found AS (SELECT * FROM grams WHERE f >= {least} AND len(ws) > 1),
parts AS (
  SELECT lang, ws, max(f) AS outer_f FROM (
    SELECT lang, f, unnest(flatten(list_transform(range(2, len(ws)), lambda k: list_transform(range(1, len(ws) - k + 2), lambda i: ws[i : i + k - 1])))) AS ws
    FROM found WHERE len(ws) > 2
  ) GROUP BY lang, ws
),
kept AS (
  SELECT x.lang, x.ws, x.f AS a FROM found x LEFT JOIN parts p ON x.lang = p.lang AND x.ws = p.ws
  WHERE p.outer_f IS NULL OR 100 * p.outer_f < {percent} * x.f
),
cuts AS (
  SELECT c.lang, c.ws, c.a, t.n, c.k, h.f AS l, e.f AS r, (1000::HUGEINT * c.a * t.n // (h.f::HUGEINT * e.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, len(ws))) AS k FROM kept) c
  JOIN grams h ON h.lang = c.lang AND h.ws = c.ws[1 : c.k]
  JOIN grams e ON e.lang = c.lang AND e.ws = c.ws[c.k + 1 : len(c.ws)]
  JOIN totals t ON t.lang = c.lang
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ws, ' ')) AS rank,
    array_to_string(ws, ' ') AS phrase, a, l, r, n, score FROM best
)
SELECT * FROM ranked WHERE rank <= {top}
"""
