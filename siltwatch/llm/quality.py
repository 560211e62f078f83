"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of which only the bag has a label. Every passage is
encoded, gated attention weighs the passages, and the weighted sum is scored. So a
document with one bad passage can be told from a clean one although nobody marked
the passage. Weights are fitted on a bounded sample of labelled rows and sent to tasks
that score whole texts where they are read, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwatch.llm.words import SPACE, slices, texts_of, words_of

PASSAGE_WORDS = 64
BUCKETS = 256
_UPPER, _DIGIT, _SIGN, _BREAK = (np.zeros(256, np.float32) for _ in range(4))
_UPPER[65:91] = 1
_DIGIT[48:58] = 1
_SIGN[[c for c in range(33, 127) if not chr(c).isalnum()]] = 1
_BREAK[10] = 1
TRUST, WIDTH = BUCKETS + 6, BUCKETS + 7
FEW_BYTES = 150
"""A passage of this size is drawn half-way (in variance) to the mean of all passages."""


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a slice, and each row's first passage.

    A text without words has one passage of zeros.
    """
    texts = texts_of(column)
    words = words_of(texts)
    counts = np.diff(words.first)
    have = np.maximum(1, -(-counts // PASSAGE_WORDS))
    first = np.concatenate([[0], np.cumsum(have)])
    out = np.zeros((int(first[-1]), WIDTH), dtype=np.float32)
    if not len(words.hash):
        return out, first
    of_word = first[words.row] + (np.arange(len(words.hash)) - words.first[words.row]) // PASSAGE_WORDS
    opens = np.flatnonzero(np.append(True, of_word[1:] != of_word[:-1]))
    begin = words.start[opens]
    # A passage's bytes run to the next one's first word; the last of a row ends with its text.
    end = np.append(begin[1:], len(texts.data))
    end = np.minimum(end, texts.offsets[words.row[opens] + 1])
    at, sizes = of_word[opens], np.maximum(end - begin, 1)
    spans = end - begin
    data = texts.data
    of_byte = np.repeat(at, spans)
    where = np.arange(len(of_byte)) + np.repeat(begin - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans)
    own = data[where].astype(np.uint32)
    gram = own * np.uint32(2654435761)
    gram[1:] += own[:-1] * np.uint32(40503)
    gram[2:] += own[:-2] * np.uint32(2246822519)
    gram = (gram ^ (gram >> np.uint32(15))) * np.uint32(2246822519)
    keys = of_byte * BUCKETS + (gram >> np.uint32(24)).astype(np.int64)
    grams = np.bincount(keys, minlength=len(out) * BUCKETS).reshape(-1, BUCKETS)
    out[:, :BUCKETS] = grams
    out[at, :BUCKETS] /= sizes[:, None]
    np.sqrt(out[:, :BUCKETS], out=out[:, :BUCKETS])
    for j, kind in enumerate((_UPPER, _DIGIT, _SIGN, _BREAK, SPACE.astype(np.float32))):
        out[:, BUCKETS + j] = np.bincount(of_byte, weights=kind[data[where]], minlength=len(out))
        out[at, BUCKETS + j] /= sizes
    members = np.diff(np.append(opens, len(of_word)))
    pairs = np.lexsort((words.hash, of_word))
    same = (words.hash[pairs][1:] == words.hash[pairs][:-1]) & (of_word[pairs][1:] == of_word[pairs][:-1])
    out[:, BUCKETS + 5] = np.bincount(of_word[pairs][1:][same], minlength=len(out))
    out[at, BUCKETS + 5] /= members
    out[at, TRUST] = np.sqrt(sizes / (sizes + FEW_BYTES))
    return out, first


@dataclass
class AttentionModel:
    """Passage encoder, gated attention and scorer."""

    hidden: int = 24
    gate: int = 12
    epochs: int = 25
    rate: float = 0.005
    decay: float = 0.01
    seed: int = 5
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        """Standardised features; those of short passages are unsure and count less."""
        return (x - self.weights["mean"]) / self.weights["scale"] * x[:, TRUST, None]

    def _forward(self, x: np.ndarray, first: np.ndarray):
        w, begin = self.weights, first[:-1]
        h = np.tanh(self._scaled(x) @ w["enc"] + w["enc0"])
        t, g = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
        a = (t * g) @ w["w"]
        sizes = np.diff(first)
        a = np.exp(a - np.repeat(np.maximum.reduceat(a, begin), sizes))
        a /= np.repeat(np.add.reduceat(a, begin), sizes)
        z = np.add.reduceat(h * a[:, None], begin)
        return h, t, g, a, z, 1 / (1 + np.exp(-(z @ w["out"] + w["out0"])))

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self._forward(x, first)[-1]

    def fit(self, bags: list[np.ndarray], labels: np.ndarray) -> AttentionModel:
        rng = np.random.default_rng(self.seed)
        rows = max(1, sum(map(len, bags)))
        mean = sum((b.sum(axis=0, dtype=np.float64) for b in bags), np.zeros(WIDTH)) / rows
        square = sum(((b.astype(np.float32) ** 2).sum(axis=0, dtype=np.float64) for b in bags), np.zeros(WIDTH)) / rows
        init = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
        self.weights = {
            "mean": mean.astype(np.float32), "scale": np.sqrt(np.maximum(square - mean**2, 0)).astype(np.float32) + np.float32(1e-3), "enc": init(WIDTH, self.hidden),
            "enc0": np.zeros(self.hidden, np.float32), "v": init(self.hidden, self.gate), "u": init(self.hidden, self.gate),
            "w": init(self.gate), "out": init(self.hidden), "out0": np.zeros(1, np.float32),
        }
        learned = [k for k in self.weights if k not in ("mean", "scale")]
        moments = {k: [np.zeros_like(self.weights[k]), np.zeros_like(self.weights[k])] for k in learned}
        step = 0
        for _ in range(self.epochs if bags else 0):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), 64):
                pick, step = order[at : at + 64], step + 1
                grads = self._gradients([bags[i] for i in pick], labels[pick])
                for k in learned:
                    m, v = moments[k]
                    m += 0.1 * (grads[k] - m)
                    v += 0.001 * (grads[k] ** 2 - v)
                    change = (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                    self.weights[k] = self.weights[k] - self.rate * (change + self.decay * self.weights[k])
        return self

    def _gradients(self, bags: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
        w, x = self.weights, np.concatenate(bags).astype(np.float32)
        first = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
        sizes, begin = np.diff(first), first[:-1]
        h, t, g, a, z, p = self._forward(x, first)
        ds = ((p - labels) / len(bags)).astype(np.float32)
        dz = np.repeat(ds[:, None] * w["out"][None, :], sizes, axis=0)
        da = (h * dz).sum(axis=1)
        da = a * (da - np.repeat(np.add.reduceat(a * da, begin), sizes))
        dt, dg = da[:, None] * g * w["w"] * (1 - t**2), da[:, None] * t * w["w"] * g * (1 - g)
        dh = (a[:, None] * dz + dt @ w["v"].T + dg @ w["u"].T) * (1 - h**2)
        return {
            "enc": self._scaled(x).T @ dh, "enc0": dh.sum(axis=0), "v": h.T @ dt, "u": h.T @ dg, "w": (t * g).T @ da,
            "out": z.T @ ds, "out0": ds.sum(keepdims=True),
        }


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        x, first = passages(part.column("text"))
        bags = [x[b:e].astype(np.float16).tobytes() for b, e in zip(first[:-1], first[1:], strict=True)]
        yield pa.record_batch({"quality": part.column("quality"), "bag": pa.array(bags, pa.binary())})


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = 6000, longest: int = 300_000) -> AttentionModel:
    """Model of ``labels.quality`` from at most ``sample`` labelled rows where ``learn`` holds.

    The rows are the first by hash of their id. Only texts of up to ``longest``
    characters are fitted on, which with ``sample`` bounds what the driver holds; any
    text is scored.
    """
    wanted = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    wanted = wanted.where(learn).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    own = docs.select("doc_id", "text").where(F.coalesce(F.length("text"), F.lit(0)) <= longest)
    rows = own.join(F.broadcast(wanted), "doc_id").select(F.col("quality").cast("int").alias("quality"), "text")
    rows = rows.mapInArrow(_encoded, "quality int, bag binary").toArrow()
    bags = [np.frombuffer(b.as_buffer(), np.float16).reshape(-1, WIDTH) for b in rows.column("bag")]
    order = np.argsort([int(b.view(np.uint16).sum(dtype=np.uint64)) for b in bags], kind="stable")
    bags = [bags[i] for i in order.tolist()]  # an order that does not depend on that of arrival
    return AttentionModel().fit(bags, rows.column("quality").to_numpy().astype(np.float32)[order])


def learnable(docs: DataFrame, labels: DataFrame, learn: Column) -> bool:
    """Whether rows where ``learn`` holds have labels of both kinds."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").where(learn).join(docs.select("doc_id"), "doc_id", "left_semi")
    return known.agg(F.count_distinct("quality")).first()[0] > 1


def quality_scores(docs: DataFrame, model: AttentionModel) -> DataFrame:
    """``docs`` with ``quality_score``, the chance of label 1; a null or blank text is scored as a passage of zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            score = model.score(*passages(part.column("text"))).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], names=[*part.schema.names, "quality_score"])

    own = docs.drop("quality_score")
    return own.mapInArrow(run, T.StructType([*own.schema.fields, T.StructField("quality_score", T.DoubleType())]))
