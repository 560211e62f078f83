"""Language by unigram models of pieces, summed over all segmentations.

Every language has probabilities for the pieces of a fixed public vocabulary. The chance
of a word is the sum over all its segmentations into pieces, by the forward algorithm;
a text's is the product over its words. Single bytes are pieces too, so any text can be
segmented. The probabilities are one expectation step (forward and backward) over all
learning texts, begun from the vocabulary's own order.

Work is done once for each distinct word of a slice of text; both passes stay where the
texts are read and only sums of fixed size (pieces by languages) are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwatch.llm.words import mix, slices, texts_of, words_of

DEFAULT_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
PLACES = 1 << 18
"""Places (words by length of the longest) that one lattice holds; longer words are summed in chunks of so many bytes."""
SLOTS_LOG = 18
SLICE = 4 << 20
UNKNOWN = "und"
MOST_LANGUAGES = 1000
_VALUES = np.random.default_rng(9).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def load_pieces(path: str) -> list[bytes]:
    """Pieces of the vocabulary in its order, a word's begin as a space; then all single bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usual = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    pieces = [model.id_to_piece(i).replace("▁", " ").encode() for i in usual]
    pieces = [p for p in pieces if b" " not in p[1:]]
    return list(dict.fromkeys([*pieces, *(bytes([b]) for b in range(256))]))


class Pieces:
    """Finds the pieces that begin at each place of a buffer of words."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.count = len(pieces)
        self.prior = 1 / (np.arange(self.count) + 100.0)
        self.prior /= self.prior.sum()
        self.keys, self.ids, self.longest = {}, {}, max(map(len, pieces))
        for length in range(1, self.longest + 1):
            own = [i for i, p in enumerate(pieces) if len(p) == length]
            if own:
                raw = np.frombuffer(b"".join(pieces[i] for i in own), np.uint8).reshape(-1, length)
                keys = self._hash(raw)
                order = np.argsort(keys)
                self.keys[length], self.ids[length] = keys[order], np.array(own)[order]
        self.slots = {}
        for length, keys in self.keys.items():
            edges = np.searchsorted(keys >> np.uint64(64 - SLOTS_LOG), np.arange((1 << SLOTS_LOG) + 1, dtype=np.uint64))
            self.slots[length] = edges.astype(np.int32)

    @staticmethod
    def _hash(raw: np.ndarray) -> np.ndarray:
        total = np.zeros(len(raw), np.uint64)
        for j in range(raw.shape[1]):
            total = total * _STEP + _VALUES[raw[:, j]]
        return mix(total)

    def at(self, data: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, places, piece ids) of pieces that end within ``left`` bytes of their place."""
        total = np.zeros(len(data), np.uint64)
        for length in range(1, self.longest + 1):
            places = np.flatnonzero(left >= length)
            if not len(places):
                return
            total[places] = total[places] * _STEP + _VALUES[data[places + length - 1]]
            if length not in self.keys:
                continue
            keys, hashes = self.keys[length], mix(total[places])
            slot = (hashes >> np.uint64(64 - SLOTS_LOG)).astype(np.int64)
            low, high = self.slots[length][slot], self.slots[length][slot + 1]
            for shift in range(int((high - low).max(initial=0))):
                hit = np.flatnonzero((low + shift < high) & (keys[np.minimum(low + shift, len(keys) - 1)] == hashes))
                yield length, places[hit], self.ids[length][low[hit] + shift]


@dataclass
class DistinctWords:
    """Some distinct words, each with a leading space, longest first; ``place`` gives their places in that order."""

    data: np.ndarray
    begin: np.ndarray
    size: np.ndarray
    place: np.ndarray


def distinct_words(start: np.ndarray, end: np.ndarray, data: np.ndarray) -> DistinctWords:
    size = end - start + 1
    order = np.argsort(-size, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    start, size = start[order], size[order]
    begin = np.concatenate([[0], np.cumsum(size)])
    where = np.arange(begin[-1]) - np.repeat(begin[:-1], size) - 1 + np.repeat(start, size)
    out = data[np.maximum(where, 0)]
    out[begin[:-1]] = 32
    return DistinctWords(out, begin[:-1], size, place)


class KnownWords:
    """Log chances of words met before in a task; emptied when it is full."""

    def __init__(self, columns: int, most: int = 1 << 20) -> None:
        self.keys, self.values, self.most = np.zeros(0, np.uint64), np.zeros((0, columns), np.float32), most

    def look_up(self, keys: np.ndarray, compute) -> np.ndarray:
        """Values of sorted distinct ``keys``; ``compute`` gives those of the unknown ones by their index."""
        if len(self.keys) > self.most:
            self.__init__(self.values.shape[1], self.most)
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        out = np.empty((len(keys), self.values.shape[1]), np.float32)
        out[known] = self.values[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            out[new] = compute(new)
            keys = np.concatenate([self.keys, keys[new]])
            order = np.argsort(keys)
            self.keys, self.values = keys[order], np.concatenate([self.values, out[new]])[order]
        return out


class Lattice:
    """All pieces of all distinct words, arranged by their end within the word."""

    def __init__(self, pieces: Pieces, own: DistinctWords) -> None:
        word = np.repeat(np.arange(len(own.size)), own.size)
        place = np.arange(len(own.data)) - own.begin[word]
        found = [(np.full(len(p), n), p, i) for n, p, i in pieces.at(own.data, own.size[word] - place)]
        length, at, self.piece = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in zip(*found, strict=True))
        self.word, self.start = word[at], place[at]
        self.end, self.own, self.longest = self.start + length, own, int(own.size.max(initial=0))
        self.by_end = self._grouped(self.end)
        self.by_start = self._grouped(self.start)

    def _grouped(self, key: np.ndarray) -> list[np.ndarray]:
        order = np.argsort(key, kind="stable")
        return np.split(order, np.searchsorted(key[order], np.arange(1, self.longest + 2)))

    def forward(self, chance: np.ndarray) -> np.ndarray:
        """Log sums over the segmentations of each prefix, by length, word and column of ``chance``."""
        logs = np.zeros((self.longest + 1, len(self.own.size), chance.shape[1]))
        alive = np.searchsorted(-self.own.size, -np.arange(self.longest + 1), side="right")
        for j in range(1, self.longest + 1):
            rows, n = self.by_end[j], int(alive[j])
            w = self.word[rows]
            part = np.exp(logs[self.start[rows], w] - logs[j - 1, w]) * chance[self.piece[rows]]
            for c in range(chance.shape[1]):
                logs[j, :n, c] = np.bincount(w, weights=part[:, c], minlength=n)
            logs[j, :n] = np.log(logs[j, :n]) + logs[j - 1, :n]
        return logs

    def log_chances(self, chance: np.ndarray) -> np.ndarray:
        """Log chance of every distinct word, by column of ``chance``."""
        return self.forward(chance)[self.own.size, np.arange(len(self.own.size))]

    def expected(self, chance: np.ndarray) -> np.ndarray:
        """Posterior of each piece of the lattice, under one column of chances."""
        n = len(self.own.size)
        ahead, back = self.forward(chance[:, None])[:, :, 0], np.zeros((self.longest + 1, n))
        whole = ahead[self.own.size, np.arange(n)]
        alive = np.searchsorted(-self.own.size, -np.arange(self.longest + 1), side="right")
        for j in range(self.longest - 1, -1, -1):
            # Sums of what follows place j, as a part of what follows the next place, which every word can reach by a byte.
            rows, n = self.by_start[j], int(alive[j + 1])
            w = self.word[rows]
            part = np.exp(back[self.end[rows], w] - back[j + 1, w]) * chance[self.piece[rows]]
            back[j, :n] = np.log(np.bincount(w, weights=part, minlength=n)[:n]) + back[j + 1, :n]
        return np.exp(ahead[self.start, self.word] + back[self.end, self.word] - whole[self.word]) * chance[self.piece]


def groups(own: DistinctWords, columns: int, places: int = PLACES) -> Iterator[tuple[int, int, DistinctWords]]:
    """Words of like length, so that a lattice of each group stays within ``places`` at four columns; a longer word is alone."""
    low, most = 0, max(1, places * 4 // max(4, columns))
    while low < len(own.size):
        high = min(len(own.size), low + max(1, most // (int(own.size[low]) + 1)))
        begin, end = own.begin[low], own.begin[high - 1] + own.size[high - 1]
        yield low, high, DistinctWords(own.data[begin:end], own.begin[low:high] - begin, own.size[low:high], np.arange(high - low))
        low = high


def _found(pieces: Pieces, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [(p, p + n, i) for n, p, i in pieces.at(data, len(data) - np.arange(len(data)))]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def long_forward(pieces: Pieces, data: np.ndarray, chance: np.ndarray, chunk: int = PLACES, keep: bool = False) -> np.ndarray:
    """Log sums of the prefixes of one word by column, all of them or the last; only the last places pass from chunk to chunk."""
    tail, kept = np.zeros((1, chance.shape[1])), [np.zeros((1, chance.shape[1]))]
    for at in range(0, len(data), chunk):
        low, high = at - len(tail) + 1, min(len(data), at + chunk)
        start, end, piece = _found(pieces, data[low:high])
        order = np.argsort(end, kind="stable")
        start, piece, edges = start[order], piece[order], np.searchsorted(end[order], np.arange(high - low + 2))
        logs = np.concatenate([tail, np.zeros((high - at, chance.shape[1]))])
        for j in range(len(tail), len(logs)):
            rows = slice(edges[j], edges[j + 1])
            logs[j] = np.log((np.exp(logs[start[rows]] - logs[j - 1]) * chance[piece[rows]]).sum(axis=0)) + logs[j - 1]
        if keep:
            kept.append(logs[len(tail) :])
        tail = logs[-pieces.longest :].copy()
    return np.concatenate(kept) if keep else tail[-1:]


def long_sums(pieces: Pieces, data: np.ndarray, chance: np.ndarray, chunk: int = PLACES) -> np.ndarray:
    """Expected count of every piece in one word, under one column of chances."""
    ahead, back, total = long_forward(pieces, data, chance[:, None], chunk, keep=True)[:, 0], np.zeros(len(data) + 1), np.zeros(pieces.count)
    for low in reversed(range(0, len(data), chunk)):
        high = min(len(data), low + chunk)
        start, end, piece = _found(pieces, data[low : high + pieces.longest])
        some = start < high - low
        order = np.argsort(start[some], kind="stable")
        start, end, piece = (x[some][order] for x in (start, end, piece))
        edges, logs = np.searchsorted(start, np.arange(high - low + 1)), back[low : high + pieces.longest + 1]
        for j in range(high - low - 1, -1, -1):
            rows = slice(edges[j], edges[j + 1])
            logs[j] = np.log((np.exp(logs[end[rows]] - logs[j + 1]) * chance[piece[rows]]).sum()) + logs[j + 1]
        weight = np.exp(ahead[low + start] + logs[end] - ahead[-1]) * chance[piece]
        total += np.bincount(piece, weights=weight, minlength=pieces.count)
    return total


def log_chances(pieces: Pieces, own: DistinctWords, chance: np.ndarray, places: int = PLACES) -> np.ndarray:
    """Log chance of every word, longest first, by column."""
    out = np.empty((len(own.size), chance.shape[1]))
    for low, high, some in groups(own, chance.shape[1], places):
        out[low:high] = long_forward(pieces, some.data, chance, places) if some.size[0] >= places else Lattice(pieces, some).log_chances(chance)
    return out


def _sums(pieces: Pieces, languages: list[str]):
    numbers = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), pieces.count))
        for part in slices(batches, limit=SLICE):
            texts = texts_of(part.column("text"))
            words = words_of(texts, exact=True)
            if len(words.hash):
                _, at, back = np.unique(words.hash, return_index=True, return_inverse=True)
                own = distinct_words(words.start[at], words.end[at], texts.data)
                number = np.array([numbers[x] for x in part.column("lang").to_pylist()])[words.row]
                used = {k: np.bincount(own.place[back[number == k]], minlength=len(own.size)) for k in np.unique(number)}
                for low, high, some in groups(own, 1):
                    if some.size[0] >= PLACES:
                        sums = long_sums(pieces, some.data, pieces.prior)
                        for k, uses in used.items():
                            total[k] += uses[low] * sums
                        continue
                    lattice = Lattice(pieces, some)
                    weight = lattice.expected(pieces.prior)
                    for k, uses in used.items():
                        total[k] += np.bincount(lattice.piece, weights=weight * uses[low:high][lattice.word], minlength=pieces.count)
        lang, piece = np.nonzero(total)
        yield pa.record_batch({"lang": lang.astype(np.int32), "piece": piece.astype(np.int32), "uses": total[lang, piece]})

    return run


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: Pieces
    chance: np.ndarray
    """Pieces by languages."""


def fit(docs: DataFrame, learn: Column, vocabulary: str = DEFAULT_VOCABULARY) -> LanguageModel:
    """Piece probabilities of each ``lang`` from all rows with text and lang where ``learn`` holds.

    Rows that repeat count as often as they occur. More than ``MOST_LANGUAGES`` languages
    are an error: a model of them would not fit a task.
    """
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").where(learn).select("text", "lang")
    languages = sorted(r[0] for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    pieces = Pieces(load_pieces(vocabulary))
    counts = np.full((pieces.count, len(languages)), 0.01)
    if languages:
        sums = rows.mapInArrow(_sums(pieces, languages), "lang int, piece int, uses double").groupBy("lang", "piece")
        found = sums.agg(F.sum("uses").alias("uses")).toArrow()  # a row per language and piece at most
        counts[found.column("piece").to_numpy(), found.column("lang").to_numpy()] += found.column("uses").to_numpy()
    return LanguageModel(languages, pieces, counts / counts.sum(axis=0))


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (the posterior of that language among those learned).

    A null text, one without letters, and any text if nothing was learned get ``und``
    with score 0. Ties go to the language that comes first. Every row gets a result of
    its own, also repeated ones; a null doc_id stays null. Other columns are ignored; an
    empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        seen = KnownWords(len(model.languages))
        for part in slices(batches, limit=SLICE):
            texts = texts_of(part.column("text"))
            words = words_of(texts, exact=True)
            total = np.zeros((part.num_rows, len(model.languages)))
            if len(words.hash) and model.languages:
                keys, at, back = np.unique(words.hash, return_index=True, return_inverse=True)
                begin, end = words.start[at], words.end[at]

                def compute(new: np.ndarray, begin=begin, end=end, data=texts.data) -> np.ndarray:
                    own = distinct_words(begin[new], end[new], data)
                    return log_chances(model.pieces, own, model.chance)[own.place]

                each = seen.look_up(keys, compute)[back]
                for k in range(len(model.languages)):
                    total[:, k] = np.bincount(words.row, weights=each[:, k], minlength=part.num_rows)
            names, scores = [], []
            for lettered, row in zip(part.column("lettered").to_pylist(), total, strict=True):
                known = bool(lettered) and len(row) > 0
                best = int(row.argmax()) if known else 0
                names.append(model.languages[best] if known else UNKNOWN)
                scores.append(float(1 / np.exp(row - row[best]).sum()) if known else 0.0)
            yield pa.record_batch({"doc_id": part.column("doc_id"), "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())})

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("text").rlike(r"\p{L}").alias("lettered"))
    return own.mapInArrow(run, "doc_id long, lang_pred string, score double")
