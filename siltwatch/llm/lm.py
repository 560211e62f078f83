"""Language-model scores of all documents, learned from a part of them.

The model is a bigram trie with Dirichlet smoothing towards add-one unigrams:
``P(w | c) = (n(c, w) + M P(w)) / (n(c) + M)``. Neither vocabulary nor trie has to fit a
worker. Both are cut into shards of bounded size, their number follows the input, and
documents travel to them as compressed columns:

1. each slice of documents becomes a block: its distinct words and its word stream;
2. vocabulary shards (by word hash) sum the words' counts and give them numbers;
3. blocks turn into (context, word) columns for the shard of the context;
4. each shard builds its trie from the learning rows and scores all rows with it;
5. a block adds up what the shards say of its documents.

A context so frequent that it would outgrow a shard is split by its next word; under this
smoothing a split list of successors gives the same probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwatch.llm.common import staged
from siltwatch.llm.trie import BigramTrie, quantised, restored
from siltwatch.llm.words import mix, slices, texts_of, words_of

END = np.uint64(0xE0D0E0D0E0D0E0D1)
"""Stands for the end of a text, which counts as a word."""
BLOCK_BYTES = 4 << 20
PACKED = "shard long, block long, kind int, a binary, b binary, c binary, d binary, e binary"


@dataclass(frozen=True)
class LmSpec:
    prior: float = 20.0
    """M of the Dirichlet smoothing, in words."""
    shard_bytes: int = 8 << 20
    """Text bytes for each shard; their number is the input's bytes by this."""


def pack(array: np.ndarray) -> bytes:
    """Byte planes, compressed."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(value: pa.Scalar | bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(value if isinstance(value, bytes) else value.as_buffer()), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def _rows(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
    kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 5]
    return pa.table({n: pa.array(c, k) for n, c, k in zip(("shard", "block", "kind", *"abcde"), columns, kinds, strict=True)})


def _blocks(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for part in slices(batches, limit=BLOCK_BYTES):
            words = words_of(texts_of(part.column("text")))
            learn = part.column("learn").to_numpy(zero_copy_only=False).astype(np.uint8)
            ends = words.first[1:] + np.arange(part.num_rows)
            stream = np.full(len(words.hash) + part.num_rows, END)
            inner = np.ones(len(stream), bool)
            inner[ends] = False
            stream[inner] = words.hash
            row = np.repeat(np.arange(part.num_rows), np.diff(words.first) + 1)
            distinct, at = np.unique(stream, return_inverse=True)
            shard = (distinct % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            uses = np.bincount(at, weights=learn[row], minlength=len(distinct)).astype(np.uint32)[order]
            distinct, shard = distinct[order], shard[order]
            block = task << 24 | number
            number += 1
            edges = np.searchsorted(shard, np.arange(shards + 1))
            rows = [(k, block, 0, pack(distinct[b:e]), pack(uses[b:e]), b"", b"", b"") for k, (b, e) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)) if e > b]
            ids = part.column("doc_id").cast(pa.int64())
            known = np.array(ids.is_valid()).astype(np.uint8)
            ids = np.asarray(ids.fill_null(0)).astype(np.int64)
            rows.append((-1, block, 1, pack(place[at]), pack(np.diff(words.first).astype(np.uint32) + np.uint32(1)), pack(ids), pack(learn), pack(known)))
            yield from _rows(rows).to_batches()

    return run


def _vocabulary(rows: pa.Table) -> pa.Table:
    """Numbers (1 and up, by falling count; 0 for words never learned) and counts of each block's words."""
    own = [(unpack(a, np.uint64), unpack(b, np.uint32)) for a, b in zip(rows.column("a"), rows.column("b"), strict=True)]
    words, at = np.unique(np.concatenate([w for w, _ in own]), return_inverse=True)
    counts = np.bincount(at, weights=np.concatenate([c for _, c in own])).astype(np.int64)
    order = np.argsort(-counts, kind="stable")
    numbers = np.zeros(len(words), np.uint32)
    numbers[order] = np.arange(1, len(words) + 1)
    numbers[counts == 0] = 0
    shard, out, begin = rows.column("shard")[0].as_py(), [], 0
    for block, (w, _) in zip(rows.column("block").to_pylist(), own, strict=True):
        some = at[begin : begin + len(w)]
        begin += len(w)
        out.append((shard, block, 2, pack(numbers[some]), pack(counts[some]), b"", b"", b""))
    out.append((shard, -1, 3, pack(np.array([(counts > 0).sum(), counts.sum()])), b"", b"", b"", b""))
    return _rows(out)


def _columns(shards: int, total: int, distinct: int, spec: LmSpec):
    """Per block: base sums of its documents, and its (context, word) columns for each shard."""
    limit = max(1, total // shards)

    def run(rows: pa.Table) -> pa.Table:
        kinds = np.asarray(rows.column("kind"))
        me, block = int(np.flatnonzero(kinds == 1)[0]), rows.column("block")[0].as_py()
        parts = sorted((rows.column("shard")[i].as_py(), i) for i in np.flatnonzero(kinds == 2).tolist())
        local = np.concatenate([unpack(rows.column("a")[i], np.uint32) for _, i in parts]).astype(np.uint64)
        counts = np.concatenate([unpack(rows.column("b")[i], np.int64) for _, i in parts])
        sizes = np.array([len(unpack(rows.column("a")[i], np.uint32)) for _, i in parts])
        owner = np.repeat(np.array([k for k, _ in parts], np.uint64), sizes)
        number = np.where(local > 0, local * np.uint64(shards) + owner, np.uint64(0))
        alone = np.log10((counts + 1) / (total + distinct + 1))
        stream, lengths = unpack(rows.column("a")[me], np.uint32), unpack(rows.column("b")[me], np.uint32).astype(np.int64)
        row = np.repeat(np.arange(len(lengths)), lengths)
        firsts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        own = alone[stream]
        base = np.bincount(row, weights=own, minlength=len(lengths))
        known = np.bincount(row, weights=counts[stream] > 0, minlength=len(lengths)).astype(np.int64)
        word = number[stream]
        context = np.zeros(len(stream), np.uint64)
        context[1:] = word[:-1]
        context[firsts] = 0
        routed = context > 0
        score = np.bincount(row[~routed], weights=own[~routed], minlength=len(lengths))
        facts = [lengths, known, base.view(np.int64), score.view(np.int64)]
        ids = [rows.column(c)[me].as_py() for c in "cde"]
        out = [(block % shards, block, 4, pack(np.stack(facts).ravel()), *ids, b"")]
        where = np.flatnonzero(routed)
        before, after = context[where], word[where]
        uses = counts[stream[where - 1]]
        pieces = -(-uses // limit)
        shard = ((before + np.where(pieces > 1, mix(after) % np.maximum(pieces, 1).astype(np.uint64), np.uint64(0))) % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((after, before, shard))
        where, before, after, uses, shard = where[order], before[order], after[order], uses[order], shard[order]
        learn = unpack(rows.column("d")[me], np.uint8)
        who = (row[where] * 2 + learn[row[where]]).astype(np.uint32)
        lower = quantised(own[where])
        wide = np.uint64 if len(number) and int(number.max()) >> 32 else np.uint32
        edges = np.searchsorted(shard, np.arange(shards + 1)).tolist()
        for k, (b, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if e > b:
                c = [before[b:e].astype(wide), after[b:e].astype(wide), uses[b:e], lower[b:e], who[b:e]]
                out.append((k, block, 5 if wide is np.uint32 else 6, *[pack(x) for x in c]))
        return _rows(out)

    return run


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(spec: LmSpec):
    def run(rows: pa.Table) -> pa.Table:
        """Build the shard's trie from learning rows, score all rows, add up by document."""
        kinds, blocks = np.asarray(rows.column("kind")), np.asarray(rows.column("block"))
        out = [tuple(rows.column(c)[i].as_py() for c in rows.column_names) for i in np.flatnonzero(kinds == 4).tolist()]
        mine = np.flatnonzero(kinds >= 5).tolist()
        kind = {5: np.uint32, 6: np.uint64}
        read = lambda i, c: unpack(rows.column(c)[i], kind[int(kinds[i])] if c in "ab" else {"c": np.int64, "d": np.uint16, "e": np.uint32}[c])
        pairs = []
        for i in mine:
            before, after, who = read(i, "a"), read(i, "b"), read(i, "e")
            learn = np.flatnonzero(who & 1)
            opens = learn[np.append(True, (before[learn][1:] != before[learn][:-1]) | (after[learn][1:] != after[learn][:-1]))] if len(learn) else learn
            n = np.diff(np.append(np.searchsorted(learn, opens), len(learn)))
            pairs.append((before[opens].astype(np.uint64), after[opens].astype(np.uint64), n, read(i, "c")[opens], read(i, "d")[opens]))
        if mine:
            before, after, n, uses, lower = (np.concatenate(x) for x in zip(*pairs, strict=True))
            order = np.lexsort((after, before))
            before, after = before[order], after[order]
            opens = np.flatnonzero(np.append(True, (before[1:] != before[:-1]) | (after[1:] != after[:-1]))) if len(order) else order
            n = np.add.reduceat(n[order], opens) if len(opens) else n
            before, after, uses, lower = before[opens], after[opens], uses[order][opens], restored(lower[order][opens])
            contexts, first, number = np.unique(before, return_index=True, return_inverse=True)
            log10 = np.log10((n + spec.prior * 10**lower) / (uses + spec.prior))
            trie = BigramTrie(contexts, np.log10(spec.prior / (uses[first] + spec.prior)), number, after, log10)
            for i in mine:
                who = read(i, "e") >> 1
                each = trie.score(read(i, "a").astype(np.uint64), read(i, "b").astype(np.uint64), restored(read(i, "d")))
                sums, met = np.bincount(who, weights=each), np.bincount(who)
                row = np.flatnonzero(met)
                out.append((-1, int(blocks[i]), 7, pack(row.astype(np.uint32)), pack(sums[row]), b"", b"", b""))
        return _rows(out)

    return run


def _documents(rows: pa.Table) -> pa.Table:
    """A block's documents: the facts kept for them, and the sums of all shards."""
    kinds = np.asarray(rows.column("kind"))
    me = int(np.flatnonzero(kinds == 4)[0])
    facts = unpack(rows.column("a")[me], np.int64).reshape(4, -1)
    score = facts[3].view(np.float64).copy()
    shards = sorted((unpack(rows.column("a")[i], np.uint32).tobytes(), unpack(rows.column("b")[i], np.float64).tobytes()) for i in np.flatnonzero(kinds == 7).tolist())
    for row, sums in shards:  # in a fixed order, so that reruns agree to the last bit
        score[np.frombuffer(row, np.uint32)] += np.frombuffer(sums)
    ids = pa.array(unpack(rows.column("b")[me], np.int64), mask=unpack(rows.column("d")[me], np.uint8) == 0)
    held = pa.array(unpack(rows.column("c")[me], np.uint8) == 0)
    return pa.table({"doc_id": ids, "held_out": held, "n_tokens": facts[0], "n_known": facts[1], "base_score": facts[2].view(np.float64), "score": score})


def lm_scores(docs: DataFrame, learn: Column, spec: LmSpec = LmSpec()) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Words are blank-separated with A-Z lowered, then one end. Rows where ``learn`` holds
    train; the others are held out. ``base_score`` sums the log10 of add-one unigrams,
    ``score`` that of the model; a first word is scored by its unigram. Null and blank
    texts are just an end. Rows that repeat a doc_id, or have none, are scored each.
    Other columns are ignored; an empty table gives no rows.
    """
    own = docs.select("doc_id", "text", F.coalesce(learn, F.lit(False)).alias("learn"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(8, -(-size // spec.shard_bytes))
    blocks = staged(own.mapInArrow(_blocks(shards), PACKED), "lm-blocks")
    named = staged(blocks.where("kind = 0").groupBy("shard").applyInArrow(_vocabulary, PACKED), "lm-words")
    distinct = total = 0
    totals = named.where("kind = 3").select("a")
    for part in totals.toLocalIterator():
        v, n = unpack(bytes(part["a"]), np.int64)
        distinct, total = distinct + int(v), total + int(n)
    both = blocks.where("kind = 1").unionByName(named.where("kind = 2"))
    columns = both.groupBy("block").applyInArrow(_columns(shards, total, distinct, spec), PACKED)
    parts = columns.groupBy("shard").applyInArrow(_score(spec), PACKED)
    scores = parts.groupBy("block").applyInArrow(_documents, SCORES)
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
