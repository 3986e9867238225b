"""A gated recurrent language model over whole corpora, and the counts it stands on.

Counts: every word of every training document is counted by one aggregation. The ``HEAD``
most frequent words go to all tasks, every other word (with the share of tokens that they
have) meets its count in a join.

Every text is written once as its words' ranks, which training and scoring read.

Model: a GRU in numpy reads the words before. Every word of the head is predicted from its state by
softmaxes, one below the other: over classes; in a class of ``CLASS_WORDS`` of the most frequent words over
these; in any other class over its ``CLASS_LEAVES`` leaves and in a leaf over its ``CLASS_WORDS`` words. All begin at
the shares of the counts (count + 1). The last class holds all words beyond the head, known or not, by these
shares plus one for an unknown word. So every text has a proper probability. As an input a
word of the most frequent ones stands for itself, another for its class. The state is carried from window to
window to the end of a document and starts at zero, so a document's score does not depend on how it is cut.

Training: truncated backpropagation with Adam. A first model is fitted on a bounded sample
(``WARM_DOCUMENTS``). Then every partition goes on from it over all its training documents, and
the models are averaged by tokens, 64 at a time in a tree, slice by slice. Repeated runs over the same
partitions give the same model; another partitioning gives a slightly different one.

A null text is the empty one, which has the end alone. Without training documents every word
is unknown. Rows without an id count as remainder 0, so they are learnt from.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.scratch import materialize
from .common import id_remainder, space_words, texts

#: Words whose counts go to every task; a bound whatever the corpus.
HEAD = 131_072
#: Words that are inputs of their own, with a class for each few; words of a class or of a leaf, and leaves of a
#: class of the other head words. What the softmaxes cover is ``HEAD``, whatever these are.
SOFT_WORDS, CLASS_WORDS, CLASS_LEAVES = 1024, 32, 128
HIDDEN = 8
#: Steps of one truncated backpropagation, and parallel streams of a partition.
WINDOW, STREAMS = 16, 256
#: First step of a leaf's weights, and how often a window meets a leaf whose gradients are added one by one.
LEAF_RATE, MET_SINGLY = 0.3, 4
#: Logits within this need no largest one taken off before their exponentials.
SMALL_LOGITS = 60
#: Parameters of one slice of a model.
PIECE = 16_384
#: Documents of the first fit on the driver.
WARM_DOCUMENTS = 400
#: Steps scored at once, and tokens held at once while scoring.
SCORED_STEPS, SCORED_TOKENS = 32, 3_000_000
#: Words whose probabilities are taken in one step.
TOGETHER = 8192
#: The end of a document; no word is empty.
END = b""


class Vocabulary:
    """Ranks and places in the tree of classes of the head words."""

    def __init__(self, words: list[bytes], counts: list[int], total: int, distinct: int):
        at = words.index(END) if END in words else None
        order = list(range(len(words)))
        if at is not None and at >= SOFT_WORDS:
            order.insert(SOFT_WORDS - 1, order.pop(at))  # the end is predicted by its class and itself
        self.rank = {words[i]: r for r, i in enumerate(order)}
        self.counts = np.array([counts[i] for i in order], np.float64)
        self.total, self.distinct = total, distinct
        n = len(words)
        self.soft = min(SOFT_WORDS, n)
        ranks = np.arange(n + 1)
        self.soft_classes = -(-self.soft // CLASS_WORDS)
        self.leaves = -(-(n - self.soft) // CLASS_WORDS)
        self.rest_classes = -(-self.leaves // CLASS_LEAVES)
        behind = (ranks - self.soft) // (CLASS_WORDS * CLASS_LEAVES)
        self.class_of = np.where(ranks < self.soft, ranks // CLASS_WORDS, self.soft_classes + behind)
        self.class_of[n] = self.soft_classes + self.rest_classes
        self.classes = int(self.class_of[n]) + 1
        # in this order words stand by class, and in a class of leaves by leaf
        group = np.where(ranks < self.soft, ranks // CLASS_WORDS, self.soft_classes + (ranks - self.soft) // CLASS_WORDS)
        group[n] = self.soft_classes + self.leaves
        self.group_of = group.astype(np.int16 if group[n] < 1 << 15 else np.int32)
        # what goes into the state: a soft word itself, of others the class
        self.inputs = np.where(ranks < self.soft, ranks, self.soft + self.class_of - self.soft_classes)
        self.n_inputs = self.soft + self.classes - self.soft_classes
        #: shares of the last class: counts and kinds beyond the head, and the unknown word
        self.tail = total - int(self.counts.sum()) + (distinct - n) + 1
        self.base = np.log10((self.counts + 1) / (total + distinct + 1))
        self.end = self.rank.get(END, n)

    def ranks_of(self, words: list[bytes]) -> np.ndarray:
        """Ranks of the words and the end; ``len(counts)`` for all beyond the head."""
        n = len(self.counts)
        found = np.fromiter(map(self.rank.get, words, repeat(n)), np.int32, len(words))
        return np.append(found, np.int32(self.end))


def _shares(sums: np.ndarray, width: int) -> np.ndarray:
    """Logarithms of the shares in groups of ``width``, the last one filled up with almost none."""
    groups = max(1, -(-len(sums) // width))
    padded = np.full(groups * width, 1e-9)
    padded[: len(sums)] = sums
    padded = padded.reshape(groups, width)
    return np.log(padded / padded.sum(axis=1, keepdims=True))


class Network:
    """Parameters as one vector, with a view for each part; the last weight of a row of
    ``classes``, ``words`` and ``branches`` is its bias, as is the last row of a leaf.

    States stand in columns, so that steps run over contiguous rows.
    """

    def __init__(self, v: Vocabulary, flat: np.ndarray | None = None, leaves: bool = True):
        h = HIDDEN
        shapes = {
            "inputs": (3 * h, v.n_inputs),
            "state": (3 * h, h),
            "classes": (v.classes, h + 1),
            "words": (max(1, v.soft_classes), CLASS_WORDS, h + 1),
            "branches": (max(1, v.rest_classes), CLASS_LEAVES, h + 1),
        }
        self.dense = sum(int(np.prod(s)) for s in shapes.values())
        self.recurrent = 3 * h * (v.n_inputs + h)
        if leaves:
            shapes["leaves"] = (max(1, v.leaves), h + 1, CLASS_WORDS)
        sizes = {k: int(np.prod(s)) for k, s in shapes.items()}
        self.flat = np.zeros(sum(sizes.values()), np.float32) if flat is None else flat.astype(np.float32)
        at = 0
        self.parts = {}
        for k, s in shapes.items():
            self.parts[k] = self.flat[at : at + sizes[k]].reshape(s)
            at += sizes[k]
        if flat is None and leaves:
            rng = np.random.default_rng(11)
            for k in ("inputs", "state", "classes", "words"):
                self.parts[k][:] = rng.normal(0, 0.3, shapes[k])
            kinds = v.counts + 1
            sums = np.bincount(v.class_of[:-1], kinds, minlength=v.classes)
            sums[v.classes - 1] = v.tail
            self.parts["classes"][:, -1] = np.log(sums / sums.sum())
            self.parts["words"][:, :, -1] = _shares(kinds[: v.soft], CLASS_WORDS)
            rest = kinds[v.soft :]
            by_leaf = np.bincount(np.arange(len(rest)) // CLASS_WORDS, rest, minlength=v.leaves)
            self.parts["branches"][:, :, -1] = _shares(by_leaf, CLASS_LEAVES)
            self.parts["leaves"][:, -1] = _shares(rest, CLASS_WORDS)

    def __getitem__(self, name: str) -> np.ndarray:
        return self.parts[name]

    def small_logits(self) -> bool:
        """Whether no state, whose features are within one, has large logits but for those of leaves."""
        rows = np.abs(self.flat[self.recurrent : self.dense]).reshape(-1, HIDDEN + 1)
        return float((rows @ np.ones(HIDDEN + 1, np.float32)).max()) < SMALL_LOGITS


def _halved(a: np.ndarray) -> np.ndarray:
    """A copy whose rows for the two gates are halved, as ``_step`` wants inputs and weights."""
    a = a.copy()
    a[: 2 * HIDDEN] *= 0.5
    return a


def _step(x: np.ndarray, h: np.ndarray, state: np.ndarray, gates: np.ndarray, new: np.ndarray, now: np.ndarray) -> np.ndarray:
    """One step of the recurrent unit into ``gates``, ``new`` and the state ``now``, from inputs and weights
    with halved gates; returns what the reset gate was multiplied with."""
    n = HIDDEN
    g = state @ h
    np.add(x[: 2 * n], g[: 2 * n], out=gates)
    np.tanh(gates, out=gates)
    gates += 1
    gates *= 0.5
    np.multiply(gates[:n], g[2 * n :], out=new)
    new += x[2 * n :]
    np.tanh(new, out=new)
    np.subtract(h, new, out=now)
    now *= gates[n:]
    now += new
    return g[2 * n :]


def _errors(logits: np.ndarray, wanted: np.ndarray, small: bool) -> tuple[np.ndarray, np.ndarray]:
    """In place, a multiple of the gradient for logits in columns, and the sums of the columns'
    exponentials, by which it is to be divided."""
    if not small:
        logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    sums = logits.sum(axis=0)
    logits.reshape(-1)[wanted * len(sums) + np.arange(len(sums))] -= sums
    return logits, sums


def _chosen(logits: np.ndarray, wanted: np.ndarray, small: bool) -> np.ndarray:
    """Log probabilities of the wanted rows of columns of logits."""
    if not small:
        logits -= logits.max(axis=0)
    own = logits[wanted, np.arange(len(wanted))]
    np.exp(logits, out=logits)
    return own - np.log(logits.sum(axis=0))


def _ordered(v: Vocabulary, wanted: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The order of the wanted words by class and leaf, and where the words of the most
    frequent classes, of each class of leaves and those beyond the head begin in it."""
    groups = v.group_of[wanted]
    order = np.argsort(groups, kind="stable")
    first = np.append(
        np.arange(v.soft_classes), np.minimum(v.soft_classes + np.arange(v.rest_classes + 1) * CLASS_LEAVES, v.group_of[-1])
    )
    return order, np.searchsorted(groups[order], first.astype(groups.dtype)).tolist()


def _levels(v: Vocabulary, wanted: np.ndarray, bounds: list[int]) -> Iterator[tuple[str, slice, list, np.ndarray]]:
    """Below the classes, of words in order: the part of the network, the places, each class's
    part of these, and what is wanted within the class."""
    for name, bounds in (("words", bounds[: v.soft_classes + 1]), ("branches", bounds[v.soft_classes :])):
        begin, end = bounds[0], bounds[-1]
        if begin < end:
            own = wanted[begin:end]
            within = own % CLASS_WORDS if name == "words" else (own - v.soft) // CLASS_WORDS % CLASS_LEAVES
            cuts = [(c, slice(a - begin, b - begin)) for c, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
            yield name, slice(begin, end), cuts, within


def _group_logits(weights: np.ndarray, own: np.ndarray, parts: list[tuple[int, slice]]) -> np.ndarray:
    logits = np.empty((weights.shape[1], own.shape[1]), np.float32)
    for c, part in parts:
        np.matmul(weights[c], own[:, part], out=logits[:, part])
    return logits


def _leaf_logits(weights: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Logits in columns of states (rows, with a one at the end), each with its leaf's weights."""
    return np.ascontiguousarray(np.matmul(own[:, None, :], weights)[:, 0].T)


class Trainer:
    """Truncated windows of parallel streams of documents: Adam, and for the leaves, of which a
    window meets few, a step by the root of all its squared gradients so far."""

    def __init__(self, v: Vocabulary, net: Network, rate: float):
        self.v, self.net, self.rate = v, net, rate
        self.m, self.s = np.zeros(net.dense, np.float32), np.zeros(net.dense, np.float32)
        self.leaf_squares = np.ones(len(net["leaves"]), np.float32)
        self.grad = Network(v, np.zeros(net.dense, np.float32), leaves=False)
        self.steps = 0

    def learn(self, documents: list[np.ndarray]) -> None:
        """Pass once over documents given as ranks with the end last."""
        v = self.v
        targets = np.concatenate(documents)
        starts = np.zeros(len(targets), bool)
        starts[np.cumsum([0, *map(len, documents[:-1])])] = True
        before = np.append(np.int32(v.end), targets[:-1])
        inputs = v.inputs[np.where(starts, v.end, before)].astype(np.int32)
        streams = max(1, min(STREAMS, len(targets) // (4 * WINDOW)))
        length = -(-len(targets) // streams)
        live = np.zeros(streams * length, bool)
        live[: len(targets)] = True
        pad = len(live) - len(targets)
        targets, inputs, starts = (np.append(a, np.zeros(pad, a.dtype)) for a in (targets, inputs, starts))
        targets, inputs, starts, live = (a.reshape(streams, length).T for a in (targets, inputs, starts, live))
        h = np.zeros((HIDDEN, streams), np.float32)
        for t in range(0, length, WINDOW):
            w = slice(t, t + WINDOW)
            h = self._window(inputs[w], targets[w], starts[w], live[w], h)

    def _window(self, inputs, targets, starts, live, h) -> np.ndarray:
        net, v, n = self.net, self.v, HIDDEN
        steps, streams = inputs.shape
        ids, wanted = inputs.ravel().astype(np.intp), targets.ravel()
        x = np.take(_halved(net["inputs"]), ids, axis=1).reshape(3 * n, steps, streams)
        # feature, step, stream; the last feature of a state is one
        states = np.ones((n + 1, steps, streams), np.float32)
        gates = np.empty((2 * n, steps, streams), np.float32)
        before, new, gn = (np.empty((n, steps, streams), np.float32) for _ in range(3))
        going, weights = (~starts).astype(np.float32), _halved(net["state"])
        for t in range(steps):
            own = np.multiply(h, going[t], out=before[:, t])
            h = states[:n, t]
            gn[:, t] = _step(x[:, t], own, weights, gates[:, t], new[:, t], h)
        r, z = gates[:n], gates[n:]
        grad = self.grad
        grad.flat.fill(0)
        order, bounds = _ordered(v, wanted)
        wanted = wanted[order]
        weight = live.ravel()[order] * np.float32(1 / max(1, int(live.sum())))
        flat = np.take(states.reshape(n + 1, -1), order, axis=1)
        small = net.small_logits()
        d, sums = _errors(net["classes"] @ flat, v.class_of[wanted], small)
        share = weight / sums
        np.matmul(d, (flat * share).T, out=grad["classes"])
        dh = net["classes"][:, :n].T @ d
        dh *= share
        for name, places, parts, within in _levels(v, wanted, bounds):
            own = flat[:, places]
            d, sums = _errors(_group_logits(net[name], own, parts), within, small)
            share = weight[places] / sums
            scaled = own * share
            back_to = np.empty((n, len(within)), np.float32)
            across = net[name][:, :, :n].transpose(0, 2, 1)
            for c, part in parts:
                np.matmul(d[:, part], scaled[:, part].T, out=grad[name][c])
                np.matmul(across[c], d[:, part], out=back_to[:, part])
            back_to *= share
            dh[:, places] += back_to
        if bounds[v.soft_classes] < bounds[-1]:
            places = slice(bounds[v.soft_classes], bounds[-1])
            leaf, within = np.divmod(wanted[places] - v.soft, CLASS_WORDS)
            dh[:, places] += self._leaves(flat[:, places], leaf, within) * weight[places]
        back_to = np.empty_like(dh)
        back_to[:, order] = dh
        dh = back_to.reshape(n, steps, streams)
        # what the gates' gradients are, but for the gradient that comes back
        to_new = (1 - z) * (1 - new * new)
        to_reset = to_new * gn * r * (1 - r)
        to_update = (before - new) * z * (1 - z)
        back = np.zeros((n, streams), np.float32)
        dx, dg = np.empty_like(x), np.empty_like(x)
        across = np.ascontiguousarray(net["state"].T)
        for t in range(steps - 1, -1, -1):
            whole = dh[:, t] + back
            np.multiply(whole, to_reset[:, t], out=dg[:n, t])
            np.multiply(whole, to_update[:, t], out=dg[n : 2 * n, t])
            da = np.multiply(whole, to_new[:, t], out=dx[2 * n :, t])
            np.multiply(da, r[:, t], out=dg[2 * n :, t])
            back = whole * z[:, t]
            back += across @ dg[:, t]
            back *= going[t]
        dx[: 2 * n] = dg[: 2 * n]
        np.matmul(dg.reshape(3 * n, -1), before.reshape(n, -1).T, out=grad["state"])
        for sums, values in zip(grad["inputs"], dx.reshape(3 * n, -1)):
            sums[:] = np.bincount(ids, values, minlength=len(sums))
        self._update(grad.flat)
        return h

    def _leaves(self, states: np.ndarray, leaf: np.ndarray, within: np.ndarray) -> np.ndarray:
        """Step the leaves of words that stand in their order; the states' gradients."""
        own = np.ascontiguousarray(states.T)
        weights = self.net["leaves"][leaf]
        d, sums = _errors(_leaf_logits(weights, own), within, False)
        d /= sums
        d = np.ascontiguousarray(d.T)
        back = np.matmul(weights[:, :HIDDEN], d[:, :, None])[:, :, 0].T
        firsts = np.flatnonzero(np.append(True, leaf[1:] != leaf[:-1]))
        times = np.diff(np.append(firsts, len(leaf)))
        # the leaves that are met most often come first
        order = np.argsort(-times, kind="stable")
        firsts, times = firsts[order], times[order]
        met = leaf[firsts]
        many = int(np.searchsorted(-times, -MET_SINGLY))
        g = own[firsts, :, None] * d[firsts, None, :]
        for k in range(1, MET_SINGLY):
            more = slice(many, int(np.searchsorted(-times, -k)))
            following = firsts[more] + k
            g[more] += own[following, :, None] * d[following, None, :]
        for i in range(many):
            part = slice(firsts[i], firsts[i] + times[i])
            np.matmul(own[part].T, d[part], out=g[i])
        by_leaf = g.reshape(len(g), -1)
        self.leaf_squares[met] += np.einsum("ij,ij->i", by_leaf, by_leaf)
        g *= (LEAF_RATE / np.sqrt(self.leaf_squares[met]))[:, None, None]
        self.net["leaves"][met] = np.subtract(weights[firsts], g, out=g)
        return back

    def _update(self, g: np.ndarray) -> None:
        norm = float(np.sqrt(g @ g))
        if norm > 1:
            g /= norm
        self.steps += 1
        change = g - self.m
        change *= 0.1
        self.m += change
        np.multiply(g, g, out=change)
        change -= self.s
        change *= 0.01
        self.s += change
        np.divide(self.s, 1 - 0.99**self.steps, out=change)
        np.sqrt(change, out=change)
        change += 1e-8
        m = np.divide(self.m, 1 - 0.9**self.steps, out=g)
        m *= self.rate
        m /= change
        self.net.flat[: self.net.dense] -= m


def _log_probabilities(v: Vocabulary, net: Network, states: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Of the wanted words, of those beyond the head the class's, for states in columns with a one at the end."""
    order, bounds = _ordered(v, wanted)
    states, wanted = np.take(states, order, axis=1), wanted[order]
    small = net.small_logits()
    found = _chosen(net["classes"] @ states, v.class_of[wanted], small)
    for name, places, parts, within in _levels(v, wanted, bounds):
        found[places] += _chosen(_group_logits(net[name], states[:, places], parts), within, small)
    if bounds[v.soft_classes] < bounds[-1]:
        places = slice(bounds[v.soft_classes], bounds[-1])
        leaf, within = np.divmod(wanted[places] - v.soft, CLASS_WORDS)
        own = np.ascontiguousarray(states[:, places].T)
        found[places] += _chosen(_leaf_logits(net["leaves"][leaf], own), within, False)
    scores = np.empty(len(wanted))
    scores[order] = found
    return scores


def score_documents(v: Vocabulary, net: Network, documents: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each document (ranks, the end last), the last class as a whole."""
    lengths = np.array([len(d) for d in documents])
    order = np.argsort(-lengths, kind="stable")
    out = np.zeros(len(documents))
    h = np.zeros((HIDDEN, len(documents)), np.float32)
    last = np.full(len(documents), v.end, np.int32)
    from_inputs, from_state = _halved(net["inputs"]), _halved(net["state"])
    for t in range(0, int(lengths.max(initial=0)), SCORED_STEPS):
        active = int(np.searchsorted(-lengths[order], -t))
        steps = min(SCORED_STEPS, int(lengths[order[0]]) - t)
        rows = order[:active]
        targets = np.full((steps, active), v.end, np.int32)
        for j, i in enumerate(rows.tolist()):
            part = documents[i][t : t + steps]
            targets[: len(part), j] = part
        valid = lengths[rows] > np.arange(t, t + steps)[:, None]
        inputs = v.inputs[np.vstack([last[None, :active], targets[:-1]])]
        states = np.ones((HIDDEN + 1, steps, active), np.float32)
        now = np.ascontiguousarray(h[:, :active])
        gates, new = np.empty((2 * HIDDEN, active), np.float32), np.empty((HIDDEN, active), np.float32)
        for k in range(steps):
            before, now = now, np.empty_like(now)
            _step(np.take(from_inputs, inputs[k], axis=1), before, from_state, gates, new, now)
            states[:HIDDEN, k] = now
        h[:, :active], last[:active] = now, targets[-1]
        own, wanted = states[:, valid], targets[valid]
        owners = np.broadcast_to(rows, valid.shape)[valid]
        scores = np.empty(len(wanted))
        for at in range(0, len(wanted), TOGETHER):
            part = slice(at, at + TOGETHER)
            scores[part] = _log_probabilities(v, net, np.ascontiguousarray(own[:, part]), wanted[part])
        out += np.bincount(owners, scores / np.log(10), minlength=len(out))
    return out


def _words(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """What ``space_words`` finds in the texts, one after the other, and how many words come before each text's end."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(batch.column("text")))
    words = split.flatten().cast(pa.binary())
    # before and behind outer spaces there are empty words
    good = pc.binary_length(words).to_numpy() > 0
    ends = np.cumsum(split.value_lengths().to_numpy(), dtype=np.int64)
    return words.filter(pa.array(good)), np.append(0, np.cumsum(good))[ends]


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)`` of all words, and of the end as the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = pc.value_counts(_words(batch)[0])
            words = pa.concat_arrays([counts.field("values"), pa.array([END], pa.binary())])
            numbers = pa.concat_arrays([counts.field("counts"), pa.array([batch.num_rows], pa.int64())])
            yield pa.RecordBatch.from_arrays([words, numbers], ["word", "n"])

    counted = docs.select("text").mapInArrow(run, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


def head_words(counts: DataFrame, most: int = HEAD) -> list:
    """The most frequent words with their counts, at most ``most``, by falling count and then by word.

    How many words have a count decides where the head ends: counts up to ``1 << 12`` are told apart, larger
    ones by sixty-fourths of a doubling. Only the head's own words are collected; a level
    that does not fit is left out whole.
    """
    n = F.col("n")
    level = F.when(n < 1 << 12, n).otherwise((1 << 12) + F.floor(F.log2(n) * 64)).cast("long").alias("level")
    found, cut = 0, None
    for row in counts.groupBy(level).agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect():
        found += row["words"]
        if found > most:
            break
        cut = row["level"]
    if cut is None:
        return []
    held = counts.where(level >= cut).collect()
    return sorted(held, key=lambda r: (-r["n"], bytes(r["word"])))


def _encoded(v: Vocabulary, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks of the words of each text; the words beyond the head with their numbers."""
    part, at, n = TaskContext.get().partitionId(), 0, len(v.counts)
    head = pa.array(list(v.rank), pa.binary())  # by rank
    for batch in batches:
        words, ends = _words(batch)
        found = pc.index_in(words, value_set=head).fill_null(n).to_numpy()
        text_ends = ends + np.arange(len(ends))  # with the ends of the texts before
        cuts = [0, *(text_ends + 1).tolist()]
        ranks = np.full(len(words) + len(ends), v.end, np.int32)
        inner = np.ones(len(ranks), bool)
        inner[text_ends] = False
        ranks[inner] = found
        beyond = np.flatnonzero(found == n)
        names = words.take(pa.array(beyond)).to_pylist()
        bounds = [0, *np.searchsorted(beyond, ends).tolist()]
        tails = [Counter(names[a:b]) for a, b in zip(bounds, bounds[1:])]
        if v.end == n:
            for tail in tails:
                tail[END] = 1
        offsets = pa.array(np.cumsum([0, *map(len, tails)]), pa.int32())
        tail_words = pa.array([w for t in tails for w in t], pa.binary())
        numbers = pa.array([k for t in tails for k in t.values()], pa.int32())
        yield pa.RecordBatch.from_pydict(
            {
                "row": pa.array(np.arange(at, at + len(ends)) + (part << 33)),
                "doc_id": batch.column("doc_id"),
                "learnt": batch.column("learnt"),
                "ranks": pa.array([ranks[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                "tail_words": pa.ListArray.from_arrays(offsets, tail_words),
                "tail_numbers": pa.ListArray.from_arrays(offsets, numbers),
            }
        )
        at += len(ends)


def _ranks(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(r, np.int32) for r in batch.column("ranks").to_pylist()]


def _learnt(v: Vocabulary, flat: np.ndarray, batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, int]:
    trainer, tokens = Trainer(v, Network(v, flat), 1e-3), 0
    for batch in batches:
        documents = _ranks(batch)
        if documents:
            trainer.learn(documents)
            tokens += sum(map(len, documents))
    return trainer.net.flat, tokens


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for the rows of each node of the tree and slice of the parameters in this partition."""
    sums: dict[tuple[int, int], list] = {}
    for batch in batches:
        for node, piece, tokens, raw in zip(*(batch.column(c).to_pylist() for c in ("node", "piece", "tokens", "params"))):
            own = sums.setdefault((node, piece), [0, 0.0])
            own[0] += tokens
            own[1] = own[1] + np.frombuffer(raw, np.float32).astype(np.float64) * tokens
    if sums:
        yield pa.RecordBatch.from_pydict(
            {
                "node": pa.array([node for node, _ in sums], pa.int64()),
                "piece": pa.array([piece for _, piece in sums], pa.int64()),
                "tokens": pa.array([s[0] for s in sums.values()], pa.int64()),
                "params": pa.array([(s[1] / s[0]).astype(np.float32).tobytes() for s in sums.values()], pa.binary()),
            }
        )


_TREE = "node long, piece long, tokens long, params binary"


def train(spark: SparkSession, learning: DataFrame, encoded: DataFrame, v: Vocabulary, documents: int) -> np.ndarray:
    """The parameters after the first fit and one pass over all of ``learning``, so many documents,
    which ``encoded`` has as ranks."""
    net = Network(v)
    if not documents:
        return net.flat
    # about twice as many as wanted by their hash, so that no partition sends more than a share
    key, slots = F.xxhash64("doc_id", "text"), 1 << 40
    drawn = learning.where(F.pmod(key, F.lit(slots)) < max(1, min(slots, slots * 2 * WARM_DOCUMENTS // documents)))
    sample = drawn.orderBy(key).limit(WARM_DOCUMENTS).collect()
    warm = Trainer(v, net, 5e-3)
    ranks = [v.ranks_of(space_words(r["text"].encode())) for r in sample]
    for _ in range(3 if ranks else 0):
        warm.learn(ranks)
    known = spark.sparkContext.broadcast((v, net.flat))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, tokens = _learnt(*known.value, batches)
        if tokens:
            pieces = [flat[i : i + PIECE].tobytes() for i in range(0, len(flat), PIECE)]
            yield pa.RecordBatch.from_pydict(
                {
                    "node": pa.array([TaskContext.get().partitionId()] * len(pieces), pa.int64()),
                    "piece": pa.array(range(len(pieces)), pa.int64()),
                    "tokens": pa.array([tokens] * len(pieces), pa.int64()),
                    "params": pa.array(pieces, pa.binary()),
                }
            )

    level = materialize(encoded.where("learnt").select("ranks").mapInArrow(run, _TREE), "models")
    pieces, last = -(-len(net.flat) // PIECE), level.agg(F.max("node")).first()[0]
    while last:
        last //= 64
        parents = level.withColumn("node", F.floor(F.col("node") / 64))
        dealt = parents.repartition(pieces * (last + 1), "node", "piece")
        level = materialize(dealt.mapInArrow(_summed, _TREE), "models")
    rows = level.orderBy("piece").collect()
    return np.concatenate([np.frombuffer(r["params"], np.float32) for r in rows])


def _head_scores(v: Vocabulary, net: Network, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Everything of a row that needs no join."""
    n, base = len(v.counts), np.append(v.base, 0.0)

    def flush(rows: list, ids: list, ranks: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {
                "row": pa.array(rows, pa.int64()),
                "doc_id": pa.array(ids, pa.int64()),
                "n_tokens": pa.array([len(r) for r in ranks], pa.int64()),
                "head_known": pa.array([int((r < n).sum()) for r in ranks], pa.int64()),
                "head_base": pa.array([float(base[r].sum()) for r in ranks], pa.float64()),
                "head_score": pa.array(score_documents(v, net, ranks), pa.float64()),
            }
        )

    rows, ids, ranks, tokens = [], [], [], 0
    for batch in batches:
        for row, doc_id, found in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), _ranks(batch)):
            rows.append(row)
            ids.append(doc_id)
            ranks.append(found)
            tokens += len(found)
            if tokens > SCORED_TOKENS:
                yield flush(rows, ids, ranks)
                rows, ids, ranks, tokens = [], [], [], 0
    if ids:
        yield flush(rows, ids, ranks)


def language_scores(spark: SparkSession, docs: DataFrame, learnt: Column) -> DataFrame:
    """Scores of every document row by a model of the rows where ``learnt`` is true."""
    all_texts = texts(docs).withColumn("learnt", F.coalesce(learnt, F.lit(False)))
    learning = all_texts.where("learnt")
    counts = materialize(word_counts(learning), "word_counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    head = head_words(counts)
    v = Vocabulary([bytes(r["word"]) for r in head], [r["n"] for r in head], total, distinct)
    # every learnt document has one end
    documents = int(v.counts[v.rank[END]]) if END in v.rank else counts.where(F.col("word") == F.lit(END)).agg(F.sum("n")).first()[0]
    words = spark.sparkContext.broadcast(v)
    encoded = materialize(
        all_texts.mapInArrow(
            lambda batches: _encoded(words.value, batches),
            "row long, doc_id long, learnt boolean, ranks binary, tail_words array<binary>, tail_numbers array<int>",
        ),
        "encoded_texts",
    )
    params = train(spark, learning, encoded, v, documents or 0)
    known = spark.sparkContext.broadcast((v, params))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, flat = known.value
        yield from _head_scores(vocabulary, Network(vocabulary, flat), batches)

    rows = materialize(
        encoded.select("row", "doc_id", "ranks").mapInArrow(
            run, "row long, doc_id long, n_tokens long, head_known long, head_base double, head_score double"
        ),
        "scored_rows",
    )
    tail = encoded.select("row", F.explode(F.arrays_zip("tail_words", "tail_numbers")).alias("t")).select(
        "row", F.col("t.tail_words").alias("word"), F.col("t.tail_numbers").alias("times")
    )
    c = F.coalesce("n", F.lit(0))
    per_row = (
        tail.join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("tail_known"),
            F.sum(F.col("times") * F.log10((c + 1) / F.lit(float(total + distinct + 1)))).alias("tail_base"),
            F.sum(F.col("times") * F.log10((c + 1) / F.lit(float(v.tail)))).alias("tail_score"),
        )
    )
    or_zero = lambda name: F.coalesce(name, F.lit(0))
    return rows.join(per_row, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("head_known") + or_zero("tail_known")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_base") + or_zero("tail_base")).alias("base_score"),
        (F.col("head_score") + or_zero("tail_score")).alias("score"),
    )


def scored_texts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Learn where crc32(doc_id as text) mod 7 is not 2, score every row."""
    found = language_scores(spark, docs, id_remainder(7) != 2)
    return found.select(
        "doc_id",
        (id_remainder(7) == 2).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )
