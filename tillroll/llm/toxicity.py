"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

A sentence is compared unit by unit. A unit is a word, or a run of single letters set apart
("i d i o t"); only letters count, any other character inside is a gap. The string kernel of
two units sums over common subsequences of three letters, each weighted by ``DECAY`` to the
stretch it covers (at most ``STRETCH``), so a unit with inserted or spaced-out characters
stays close to the plain one. The normalised kernel is sharpened to ``exp(-2 g (1 - k))``.

Landmarks are units of the training sentences: those most typical of toxic documents, and
common ones of clean documents, first those that resemble the former. The kernel values to the landmarks, whitened by the landmarks' own kernel
matrix, are coordinates; a sentence has the largest value of its units for each landmark, so
repetitions don't add up. A sentence of a clean
document is an example against. Of a toxic document those are examples for that come close to a
typical landmark, later those that the machine itself finds toxic: sentence labels and machine
are fitted in turns. A document is as toxic as its most toxic sentence, put on a scale
of 0 to 1 by a logistic curve.

The machine learns from a bounded sample of labelled documents (``Limits``), scoring covers
every text whole. A null text is the empty one. Repeated rows have equal scores. Without
examples of both labels, or where nothing is typical of toxic ones, the score is 0.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import id_remainder, small_batches, texts, unused

DECAY = 0.7
STRETCH = 9
SHARPNESS = 4.0
LEAST_VALUE = 0.05
#: Text without sentence ends is cut after so many units.
LONGEST_SENTENCE = 25
#: Longer units are compared piece by piece; pieces overlap by half.
LONGEST = 32
LETTERS = 27
#: Triples of units compared with all landmarks in one step, and documents split up together.
AT_ONCE = 32_768
DOCUMENTS_AT_ONCE = 100
#: Landmarks of a group with one bound.
TOGETHER = 8
_SENTENCES = re.compile(r"[.!?]\s+|\n")
#: A landmark is typical of toxic documents if it is in at least so many of their distinct
#: sentences, and at least so many times as often in them as in others.
LEAST_SENTENCES = 5
LEAST_RATIO = 10


@dataclass(frozen=True)
class Limits:
    """Bounds of what is learnt from; scoring has none."""

    toxic_documents: int = 1000
    clean_documents: int = 2000
    toxic_landmarks: int = 96
    clean_landmarks: int = 40


#: Letters to small ones, all other characters to blanks.
_ASCII = "".join(chr(i).lower() if chr(i).isalpha() else " " for i in range(128))


def plain_letters(unit: str) -> str:
    """Small letters a-z without accents; "{" for other letters, a blank for all else."""
    if unit.isascii() and unit.isalpha():
        return unit.lower()
    if unit.isascii():
        return unit.translate(_ASCII).strip()
    unit = "".join(c for c in unicodedata.normalize("NFKD", unit) if c < "\u0300" or not unicodedata.combining(c))
    if unit.isascii():
        return unit.translate(_ASCII).strip()
    return "".join(c if "a" <= c <= "z" else "{" if c.isalpha() else " " for c in unit.lower()).strip()


def units(sentence: str) -> list[str]:
    """Words, with runs of three or more words of one letter each put together."""
    words = sentence.split()
    lengths = list(map(len, words))
    if lengths.count(1) + lengths.count(2) < 3:
        return words
    short = [i for i, n in enumerate(lengths) if n == 1 or n == 2 and not words[i].isalpha()]
    if len(short) < 3:
        return words
    single = {i for i in short if sum(map(str.isalpha, words[i])) == 1}
    out, i = [], 0
    while i < len(words):
        j = i
        while j in single:
            j += 1
        if j - i >= 3:
            out.append(" ".join(words[i:j]))
            i = j
        else:
            out += words[i : max(j, i + 1)]
            i = max(j, i + 1)
    return out


def sentences(text: str) -> list[list[str]]:
    """The units of each sentence."""
    out = []
    for sentence in _SENTENCES.split(text):
        found = units(sentence)
        if len(found) <= LONGEST_SENTENCE:
            if found:
                out.append(found)
        else:
            out += [found[i : i + LONGEST_SENTENCE] for i in range(0, len(found), LONGEST_SENTENCE)]
    return out


_TRIPLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Index triples of a unit of this length, and their weights."""
    if length not in _TRIPLES:
        found = [
            (i, j, k)
            for i in range(length)
            for j in range(i + 1, min(length, i + STRETCH))
            for k in range(j + 1, min(length, i + STRETCH))
        ]
        index = np.array(found, np.int64).reshape(-1, 3)
        _TRIPLES[length] = index, (DECAY ** (index[:, 2] - index[:, 0] + 1)).astype(np.float32)
    return _TRIPLES[length]


def _coded(same_length: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For units of one length, the code of each triple and its weight, 0 across a gap."""
    raw = np.frombuffer("".join(same_length).encode("ascii"), np.uint8).reshape(len(same_length), -1)
    codes = raw.astype(np.int32) - 97
    index, weights = _triples(raw.shape[1])
    a, b, c = (codes[:, index[:, i]] for i in range(3))
    weighted = np.where((a >= 0) & (b >= 0) & (c >= 0), weights, np.float32(0))
    return np.where(weighted > 0, (a * LETTERS + b) * LETTERS + c, 0), weighted


def _norms(codes: np.ndarray, weights: np.ndarray, by_triple: np.ndarray) -> np.ndarray:
    """Length of each unit's vector, where a triple that occurs again adds up."""
    keys = codes * 2048 + np.arange(codes.shape[1], dtype=np.int32)
    keys[weights == 0] = LETTERS**3 * 2048
    keys.sort(axis=1)
    sorted_weights = np.append(by_triple, np.float32(0))[np.minimum(keys & 2047, len(by_triple))]
    sorted_weights[keys == LETTERS**3 * 2048] = 0
    keys >>= 11
    first = np.ones(keys.shape, bool)
    first[:, 1:] = keys[:, 1:] != keys[:, :-1]
    flat = np.flatnonzero(first)
    sums = np.add.reduceat(sorted_weights.ravel(), flat).astype(np.float64)
    return np.sqrt(np.bincount(flat // keys.shape[1], sums * sums, minlength=len(keys)))


def _grouped(dense: np.ndarray) -> np.ndarray:
    """The largest part of each triple in groups of landmarks, each next to the one most like it."""
    alike = dense.T @ dense
    order = list(range(min(1, len(alike))))
    left = np.ones(len(alike), bool)
    while order and len(order) < len(alike):
        left[order[-1]] = False
        order.append(int(np.argmax(np.where(left, alike[order[-1]], -1))))
    groups = [dense[:, order[i : i + TOGETHER]].max(axis=1) for i in range(0, len(order), TOGETHER)]
    return np.array(groups, np.float32).reshape(len(groups), len(dense))


def kernel(plain: list[str], landmarks: np.ndarray) -> np.ndarray:
    """Sharpened kernel of units (letters as ``plain_letters``) to unit-length landmarks.

    Values under ``LEAST_VALUE`` are zero. A unit whose values can't reach that even with the
    least length its vector may have is not measured any further.
    """
    least = 1 + np.log(LEAST_VALUE) / (2 * SHARPNESS)
    used = np.flatnonzero(landmarks.any(axis=1))
    compact = np.zeros(LETTERS**3, np.int32)
    compact[used] = np.arange(1, len(used) + 1)
    dense = landmarks[used]
    largest = dense.max(axis=1, initial=0)
    groups = _grouped(dense)
    out = np.zeros((len(plain), landmarks.shape[1]), np.float32)
    by_length: dict[int, list[int]] = {}
    for i, unit in enumerate(plain):
        if len(unit) >= 3:
            by_length.setdefault(len(unit), []).append(i)
    for length, rows in by_length.items():
        step = max(1, AT_ONCE // max(1, len(_triples(length)[0])))
        for begin in range(0, len(rows), step):
            part = rows[begin : begin + step]
            codes, weights = _coded([plain[i] for i in part])
            slots = compact[codes]
            slots[weights == 0] = 0
            hits = np.flatnonzero(slots)
            if not len(hits):
                continue
            owners = hits // codes.shape[1]
            place, own = slots.ravel()[hits] - 1, weights.ravel()[hits]
            # no landmark can have more of a unit than its triples' largest parts together
            bound = np.bincount(owners, own * largest[place], minlength=len(part))
            able = bound >= 0.999 * least * np.sqrt((weights * weights).sum(axis=1))
            some = able[owners]
            if not some.any():
                continue
            owners, place, own = owners[some], place[some], own[some]
            # nor more than its triples' largest parts in one group of landmarks
            bound = np.zeros(len(part))
            for most in groups:
                np.maximum(bound, np.bincount(owners, own * most[place], minlength=len(part)), out=bound)
            able = bound >= 0.999 * least * np.sqrt((weights * weights).sum(axis=1))
            some = able[owners]
            if not some.any():
                continue
            owners, place, own = owners[some], place[some], own[some]
            begins = np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))
            touched = owners[begins]
            dots = np.add.reduceat(dense[place] * own[:, None], begins)
            norms = _norms(codes[touched], weights[touched], _triples(length)[1])
            values = sharpened(dots / norms[:, None])
            out[np.array(part)[touched]] = np.where(values < LEAST_VALUE, 0, values)
    return out


def landmark_vectors(plain: list[str]) -> np.ndarray:
    """Triples by landmarks, each of unit length."""
    vectors = np.zeros((LETTERS**3, len(plain)), np.float32)
    for m, unit in enumerate(plain):
        codes, weights = _coded([unit])
        np.add.at(vectors[:, m], codes[0], weights[0])
    return vectors / np.maximum(np.linalg.norm(vectors, axis=0), 1e-9)


def sharpened(k: np.ndarray) -> np.ndarray:
    return np.exp(-2 * SHARPNESS * (1 - np.minimum(k, 1)))


def pieces_of(unit: str) -> list[str]:
    plain = plain_letters(unit)
    if len(plain) <= LONGEST:
        return [plain] if len(plain) >= 3 else []
    return [p for i in range(0, len(plain), LONGEST // 2) if len(p := plain[i : i + LONGEST].strip()) >= 3]


class Machine:
    """The fitted machine: landmarks, one weight each, an offset and the logistic curve."""

    def __init__(self, vectors: np.ndarray, weights: np.ndarray, offset: float, curve: tuple[float, float]):
        self.vectors, self.weights, self.offset, self.curve = vectors, weights, offset, curve
        self._units: dict[str, np.ndarray | None] = {}
        self._pieces: dict[str, np.ndarray | None] = {}

    def __reduce__(self):
        return Machine, (self.vectors, self.weights, self.offset, self.curve)

    def learn_units(self, wanted: set[str], most: int = 200_000) -> dict[str, np.ndarray | None]:
        """The kernel values of these units, none where all are zero, computed or remembered;
        memory is bounded by ``most`` units and what one batch of documents holds."""
        if len(self._units) > most:
            self._units = {u: v for u, v in self._units.items() if u in wanted}
        if len(self._pieces) > most:
            self._pieces = {}
        parts = {u: pieces_of(u) for u in wanted.difference(self._units)}
        missing = list({p for ps in parts.values() for p in ps}.difference(self._pieces))
        values = kernel(missing, self.vectors)
        self._pieces.update(dict.fromkeys(missing))
        for i in np.flatnonzero(values.any(axis=1)).tolist():
            self._pieces[missing[i]] = values[i].copy()
        for unit, ps in parts.items():
            found = [v for v in map(self._pieces.__getitem__, ps) if v is not None]
            self._units[unit] = np.max(found, axis=0) if found else None
        return self._units

    def raw_scores(self, documents: list[str]) -> list[float]:
        """Distance of each document's most toxic sentence from the border."""
        split = [sentences(t) for t in documents]
        wanted = set().union(*(s for doc in split for s in doc))
        known = self.learn_units(wanted).__getitem__
        near = {u for u in wanted if known(u) is not None}
        out = []
        for doc in split:
            best = 0.0
            for s in doc:
                if not near.isdisjoint(s):
                    found = [known(u) for u in s if u in near]
                    pooled = found[0] if len(found) == 1 else np.max(found, axis=0)
                    best = max(best, float(pooled @ self.weights))
            out.append(self.offset + best)
        return out

    def scores(self, documents: list[str]) -> np.ndarray:
        slope, shift = self.curve
        # the words of a few documents at a time, so that memory does not depend on the batch
        step = DOCUMENTS_AT_ONCE
        parts = (documents[i : i + step] for i in range(0, len(documents), step))
        raw = np.array([f for part in parts for f in self.raw_scores(part)], np.float64)
        return 1 / (1 + np.exp(-np.clip(slope * raw + shift, -500, 500)))


def _blocks(x: np.ndarray, rows: int = 8192) -> Iterator[tuple[slice, np.ndarray]]:
    """The rows of ``x`` in double precision, so many at a time."""
    for begin in range(0, len(x), rows):
        part = slice(begin, begin + rows)
        yield part, x[part].astype(np.float64)


def _times(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.concatenate([rows @ w for _, rows in _blocks(x)])


def _hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps on the violating examples.

    The last column of ``x`` is one throughout; its weight is the offset.
    """
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-8
    for _ in range(30):
        squares, target = np.diag(ridge), np.zeros(len(w))
        for part, rows in _blocks(x):
            bad = y[part] * (rows @ w) < 1
            rows, weighted = rows[bad], rows[bad] * weight[part][bad, None]
            squares += weighted.T @ rows
            target += weighted.T @ y[part][bad]
        step = np.linalg.solve(squares, target)
        if np.abs(step - w).max() < 1e-6:
            break
        w = step
    return w


def _logistic(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve that turns distances into shares of toxic documents."""
    a, b = 4.0, 0.0
    f = np.clip(f, -3, 3)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * f + b, -30, 30)))
        g = np.array([((p - y) * f).sum() + a - 4, (p - y).sum() + b])
        v = p * (1 - p)
        h = np.array([[(v * f * f).sum() + 1, (v * f).sum()], [(v * f).sum(), v.sum() + 1]])
        change = np.clip(np.linalg.solve(h, g), -0.5, 0.5)
        a, b = a - change[0], b - change[1]
        if np.abs(change).max() < 1e-8:
            break
    return float(max(a, 1e-3)), float(b)


def _landmarks(
    split: list, toxic: list[int], cut: dict[str, list[str]], limits: Limits
) -> tuple[list[str], list[str]]:
    """Units typical of toxic documents, and common ones of clean documents."""
    # a sentence that is repeated, as in copies of a document, counts once for each label
    distinct_sentences = [{s for d, label in zip(split, toxic) if label == k for s in d} for k in (0, 1)]
    seen = [Counter(), Counter()]
    for label in (0, 1):
        for s in distinct_sentences[label]:
            seen[label].update({p for u in s for p in cut[u]})
    n0, n1 = (max(1, len(s)) for s in distinct_sentences)
    rates = {u: (n / n1, (seen[0][u] + 0.5) / n0) for u, n in seen[1].items() if n >= LEAST_SENTENCES}
    gain = {u: a * np.log(a / b) - a + b for u, (a, b) in rates.items() if a >= LEAST_RATIO * b}
    typical = sorted(gain, key=lambda u: (-gain[u], u))
    typical = typical[: limits.toxic_landmarks]
    # of clean units those that look like the typical ones matter most, the commonest first
    often = [u for u, n in seen[0].items() if n >= LEAST_SENTENCES and u not in gain]
    alike = kernel(often, landmark_vectors(typical)).max(axis=1, initial=0)
    order = sorted(range(len(often)), key=lambda i: (alike[i] < 0.2, -seen[0][often[i]], often[i]))
    return typical, [often[i] for i in order[: limits.clean_landmarks]]


def fit(documents: list[str], toxic: list[int], limits: Limits = Limits()) -> Machine | None:
    """Fit on documents (bounded by the caller) with labels 0 or 1."""
    y = np.array(toxic)
    if len(set(toxic)) < 2:
        return None
    one: dict[str, str] = {}  # equal words share their memory
    split = [[tuple(one.setdefault(u, u) for u in s) for s in sentences(t)] for t in documents]
    cut = {u: pieces_of(u) for u in one}
    typical, common = _landmarks(split, toxic, cut, limits)
    if not typical:
        return None
    names = typical + common
    vectors = landmark_vectors(names)
    gram = kernel(names, vectors).astype(np.float64)
    values, basis = np.linalg.eigh((gram + gram.T) / 2)
    whiten = basis @ np.diag(1 / np.sqrt(np.maximum(values, 1e-2))) @ basis.T

    near: dict[str, np.ndarray] = {}
    distinct = sorted(set().union(*cut.values()))
    for begin in range(0, len(distinct), 20_000):
        part = distinct[begin : begin + 20_000]
        values = kernel(part, vectors)
        near.update((part[i], values[i].copy()) for i in np.flatnonzero(values.any(axis=1)).tolist())

    # sentences away from all landmarks are one example against, weighted by their number;
    # the table is as large as all sentences would need, only rows in use take up memory
    total = sum(map(len, split))
    x, bag = np.empty((total + 1, len(names) + 1), np.float32), np.empty(total, np.int64)
    n = 0
    for d, doc in enumerate(split):
        for s in doc:
            found = [near[p] for u in s for p in cut[u] if p in near]
            if found:
                np.max(found, axis=0, out=x[n, :-1])
                bag[n] = d
                n += 1
    if not n:
        return None
    has = np.array([bool(doc) for doc in split])
    split = one = cut = distinct = near = None
    x, bag = x[: n + 1], bag[:n]
    x[n], x[:, -1] = 0, 1
    positive = (y[bag] == 1) & (x[:n, : len(typical)].max(axis=1, initial=0) > 0.5)
    if not positive.any():
        return None
    for part, rows in _blocks(x):
        x[part, :-1] = rows[:, :-1] @ whiten
    times = np.append(np.ones(n), total - n)
    for _ in range(8):
        sign = np.append(np.where(positive, 1.0, -1.0), -1.0)
        w = _hinge(x, sign, times / max(1, positive.sum()))
        f = _times(x[:n], w)
        again = (y[bag] == 1) & (f > 0)
        if not again.any() or (again == positive).all():
            break
        positive = again
    w, offset = w[:-1], float(w[-1])
    best = np.full(len(y), offset)
    np.maximum.at(best, bag, f)
    return Machine(vectors, (whiten @ w).astype(np.float32), offset, _logistic(best[has], y[has]))


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, limits: Limits) -> tuple[list[str], list[int]]:
    """Texts and labels of at most as many documents as ``limits`` say, chosen by a hash of the id."""
    rated = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .where(learn)
    )
    chosen = [
        rated.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        for label, most in ((1, limits.toxic_documents), (0, limits.clean_documents))
    ]
    # at most as many ids as the limits say
    few = F.broadcast(chosen[0].union(chosen[1]))
    rows = texts(docs).join(few, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return [r["text"] for r in rows], [r["toxic"] for r in rows]


def train(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> Machine | None:
    """The machine fitted on rows whose crc32(doc_id as text) mod 5 is not 0."""
    return fit(*labelled_sample(docs, labels, id_remainder(5) != 0, limits), limits)


def with_scores(docs: DataFrame, machine: Machine | None, column: str = "score") -> DataFrame:
    """The rows of ``docs`` with a score column at the end; ``text`` is read, null as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for i in range(0, batch.num_rows if machine else 0, 1000):
                some = batch.column("text").slice(i, 1000).to_pylist()
                scores[i : i + 1000] = machine.scores([t or "" for t in some])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, column])

    kept = docs.drop(column)
    return small_batches(kept).mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(column, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every document row."""
    scored = with_scores(texts(docs), train(docs, labels, limits))
    return scored.select(
        "doc_id",
        (id_remainder(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents without those predicted toxic."""
    (score,) = unused(docs, "toxicity_score")
    scored = with_scores(docs, train(docs, labels, limits), score)
    return scored.where(F.col(score) < 0.5).select(*docs.columns)
