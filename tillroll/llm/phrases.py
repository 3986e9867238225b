"""Collocations: phrases of two or three words that stand together more often than their parts suggest.

Candidates come level by level. A phrase of k words can only be frequent if its first and its
last k - 1 words are, so positions are kept where both pass a bit filter of the frequent phrases of
the level below (a filter of fixed size, which may let through too much but never too little).
Every task sums what it has kept, up to ``least`` a phrase, and packs it by buckets of a hash; phrases
whose hash's sums reach ``least`` are candidates: none that is frequent is lost.

Candidates are dealt into tries of at most about ``TRIE`` phrases, each a double array (``base``,
``check``) over the digits of word codes. Tries are broadcast one after the other; a task advances the
states of all positions of a chunk of text together, level by level, and counts accepting states with
``bincount``. The sums over the tasks are the counts. One pass over the texts is needed per trie.

Null languages count as ``und``. Null and empty texts have no words; repeated rows count as often as
they stand; an empty table has no phrases. Ties are closed by the phrase. Extra columns are not read.
A phrase never crosses a piece, a text or a row. Counts must stay below 10**16.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from ..sources.scratch import materialize
from .common import small_batches

LEAST = 10
LONGEST = 3
COVERED = 50
TOP = 2000
#: Phrases of a trie, on average; this bounds what is broadcast (60 MB and the words).
TRIE = 1_000_000
#: Bits of a filter of frequent phrases, the same at every size.
FILTER_BITS = 1 << 26
#: Bytes of text looked at together.
CHUNK = 1 << 20
#: Words a task knows and phrases it holds, of all languages, before it hands on what it has; codes fit 21 bits.
KNOWN, HELD = 500_000, 2_400_000
#: Phrases handed on at a time, and words of the texts for each bucket of phrases that is summed at once.
SENT, BUCKET_WORDS = 50_000, 500_000
_SHIFT = 21
#: Groups a language's phrases are ranked in before the groups' first ones are ranked together.
SALTS = (1024, 32)

END = b"."
_PIECES = bytes(
    ord(END) if chr(c) in ".,;:!?\n\v\f\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)


def by_language(docs: DataFrame) -> DataFrame:
    """Language and text alone."""
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def _parts(text: bytes) -> Iterator[bytes]:
    """The text whole, or cut at ends of pieces if it is long."""
    begin = 0
    while len(text) - begin > CHUNK and (cut := text.find(END, begin + CHUNK)) >= 0:
        yield text[begin:cut]
        begin = cut + 1
    yield text[begin:]


def _tokens(parts: list[bytes]) -> pa.Array:
    """The words of the parts of texts, kept in Arrow's memory; ``END`` stands between pieces."""
    joined = pa.array([END.join(parts).replace(END, b" . ")], pa.binary()).cast(pa.string(), safe=False)
    words = pc.ascii_split_whitespace(joined).flatten().cast(pa.binary())
    return words.filter(pc.greater(pc.binary_length(words), 0))


def token_lists(batch: pa.RecordBatch) -> Iterator[tuple[bytes, pa.Array]]:
    """Language and words of chunks of the batch's texts; ``END`` stands between pieces."""
    texts: dict[bytes, list[bytes]] = {}
    columns = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("lang", "text"))
    for lang, text in zip(*columns):
        texts.setdefault(lang, []).append(text)
    for lang, own in texts.items():
        held, size = [], 0
        for text in own:
            for part in _parts(text.translate(_PIECES)):
                held.append(part)
                size += len(part)
                if size >= CHUNK:
                    yield lang, _tokens(held)
                    held, size = [], 0
        if held:
            yield lang, _tokens(held)


def _looked_up(code: Callable[[bytes], int], tokens: pa.Array, kind: type = np.int64) -> np.ndarray:
    """The code of every word; each different one is looked up once."""
    different = pc.dictionary_encode(tokens)
    codes = np.fromiter(map(code, different.dictionary.to_pylist()), kind, len(different.dictionary))
    return codes[different.indices.to_numpy()]


class Words(dict):
    """Codes of a language's words in order of appearance; the end of a piece is -1."""

    def __init__(self):
        super().__init__({END: -1})
        self.names: list[bytes] = []
        self._hashes = np.empty(0, np.uint64)

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self.names)
        self.names.append(word)
        return code

    def codes(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))

    def hashes(self) -> np.ndarray:
        fresh = self.names[len(self._hashes) :]
        if fresh:
            found = np.fromiter(map(xxh64_intdigest, fresh), np.uint64, len(fresh))
            self._hashes = np.concatenate([self._hashes, found])
        return self._hashes


def word_counts(plain: DataFrame) -> DataFrame:
    """``(lang, phrase, f)``: how often each word occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def merged() -> list[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).group_by(["lang", "phrase"], use_threads=False)
            summed = whole.aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})
            return summed.select(["lang", "phrase", "n"]).combine_chunks().to_batches()

        for batch in batches:
            for lang, tokens in token_lists(batch):
                counts = pc.value_counts(tokens)
                counts = counts.filter(pc.not_equal(counts.field("values"), END))
                held.append(_rows(lang, counts.field("values"), counts.field("counts")))
            if sum(map(len, held)) > 2 * KNOWN:
                held = merged()
                if sum(map(len, held)) > KNOWN:
                    yield from held
                    held = []
        if held:
            yield from merged()

    found = plain.mapInArrow(run, "lang string, phrase string, n long")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def _rows(lang: bytes, phrases: pa.Array, counts: pa.Array) -> pa.RecordBatch:
    named = pa.array([lang], pa.binary()).take(pa.array(np.zeros(len(phrases), np.int32)))
    return pa.RecordBatch.from_arrays(
        [named.cast(pa.string()), phrases.cast(pa.string()), counts.cast(pa.int64())], ["lang", "phrase", "n"]
    )


def _mixed(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from the hash of what comes before its last word and that word's hash."""
    x = (before ^ word) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(FILTER_BITS - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def phrase_filter(phrases: DataFrame) -> np.ndarray:
    """The bits of all ``(lang, phrase)``: two for each, in ``FILTER_BITS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = pc.split_pattern(batch.column("phrase"), " ")
            sizes = split.value_lengths().to_numpy()
            begins = np.cumsum(sizes) - sizes
            words = _looked_up(xxh64_intdigest, split.flatten().cast(pa.binary()), np.uint64)
            hashed = _looked_up(xxh64_intdigest, batch.column("lang").cast(pa.binary()), np.uint64)
            for k in range(int(sizes.max(initial=0))):
                longer = np.flatnonzero(sizes > k)
                hashed[longer] = _mixed(hashed[longer], words[begins[longer] + k])
            placed = np.concatenate(_places(hashed))
            slots, where = np.unique(placed >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(slots), np.uint64)
            np.bitwise_or.at(bits, where, np.uint64(1) << (placed & np.uint64(63)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots.view(np.int64)), pa.array(bits.view(np.int64))], ["slot", "bits"]
            )

    found = phrases.select("lang", "phrase").mapInArrow(run, "slot long, bits long")
    table = found.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(FILTER_BITS >> 6, np.int64)
    words[table.column("slot").to_numpy()] = table.column("bits").to_numpy()
    return words.view(np.uint8)


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    first, second = _places(hashes)
    eight, low = np.uint64(3), np.uint64(7)
    found = (bits[first >> eight] >> (first & low).astype(np.uint8)) & 1
    return (found & (bits[second >> eight] >> (second & low).astype(np.uint8))).astype(bool)


def candidates(plain: DataFrame, frequent: DataFrame, size: int, least: int, buckets: int = 16) -> DataFrame:
    """``(lang, phrase)`` of ``size`` words that occur ``least`` times and whose parts of
    ``size - 1`` words are among ``frequent`` (or taken for such by the filter). Tasks hand on their
    phrases packed by bucket of a hash, so that Spark moves few rows; a bucket is summed at once."""
    filter_of = plain.sparkSession.sparkContext.broadcast(phrase_filter(frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filter_of.value
        known: dict[bytes, Words] = {}
        held: dict[bytes, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(lang: bytes) -> tuple[np.ndarray, np.ndarray]:
            if len(held[lang]) > 1:
                keys, counts = map(np.concatenate, zip(*held[lang]))
                keys, where = np.unique(keys, return_inverse=True)
                held[lang] = [(keys, np.bincount(where, counts).astype(np.int64))]
            keys, counts = held[lang][0]
            return keys, np.minimum(counts, least)

        def flush(lang: bytes) -> Iterator[pa.RecordBatch]:
            keys, counts = merged(lang)
            del held[lang]
            yield from _packed(lang, known[lang], keys, counts, size, buckets)

        def most(limit: int) -> Iterator[pa.RecordBatch]:
            """Hand on the largest languages until no more than the limit is held."""
            while (total := sum(len(k) for own in held.values() for k, _ in own)) and total > limit:
                yield from flush(max(held, key=lambda x: sum(len(k) for k, _ in held[x])))

        for batch in batches:
            for lang, tokens in token_lists(batch):
                different = pc.dictionary_encode(tokens)
                names, places = different.dictionary.to_pylist(), different.indices.to_numpy()
                if len(places) >= size:
                    hashes = np.fromiter(map(xxh64_intdigest, names), np.uint64, len(names))[places]
                    inside = places != (names.index(END) if END in names else -1)
                    state = np.full(len(places), xxh64_intdigest(lang), np.uint64)
                    whole = np.ones(len(places), bool)
                    for k in range(size - 1):
                        ahead = len(places) - k
                        state = _mixed(state[:ahead], hashes[k:])
                        whole = whole[:ahead] & inside[k:]
                    at = np.flatnonzero(whole)
                    whole[at] = _passes(bits, state[at])
                    at = np.flatnonzero(whole[:-1] & whole[1:]) if size > 1 else at
                    # only words of phrases that are kept get codes
                    words = known.setdefault(lang, Words())
                    used = np.zeros(len(names), bool)
                    for k in range(size):
                        used[places[at + k]] = True
                    codes = np.zeros(len(names), np.int64)
                    codes[used] = words.codes([names[i] for i in np.flatnonzero(used).tolist()])
                    keys = codes[places[at]]
                    for k in range(1, size):
                        keys = keys << _SHIFT | codes[places[at + k]]
                    held.setdefault(lang, []).append(np.unique(keys, return_counts=True))
                    if sum(len(k) for own in held.values() for k, _ in own) > HELD:
                        for name in held:
                            merged(name)
                        yield from most(HELD // 2)
                if sum(len(w.names) for w in known.values()) > KNOWN:
                    yield from most(0)
                    held.clear()
                    known.clear()
        for lang in list(held):
            yield from flush(lang)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[bytes, bytes]] = []
        hashes, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for batch in batches:
            langs, joined = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("lang", "phrases"))
            rows += zip(langs, joined)
            hashes += (np.frombuffer(h, np.uint64) for h in batch.column("hashes").to_pylist())
            counts += (np.frombuffer(c, np.int64) for c in batch.column("counts").to_pylist())
        _, where = np.unique(np.concatenate(hashes), return_inverse=True)
        kept = (np.bincount(where, np.concatenate(counts)) >= least)[where]
        found: dict[bytes, set[bytes]] = {}
        begin = 0
        for (lang, joined), own in zip(rows, hashes[1:]):
            places = np.flatnonzero(kept[begin : begin + len(own)]).tolist()
            begin += len(own)
            if places:
                # all phrases of a hash are kept: if two have the same, neither is lost
                found.setdefault(lang, set()).update(map(joined.split(b"\n").__getitem__, places))
        for lang, phrases in found.items():
            ordered = sorted(phrases)
            named = pa.array(ordered, pa.binary())
            yield _rows(lang, named, pa.array(np.zeros(len(ordered), np.int64))).select(["lang", "phrase"])

    found = plain.mapInArrow(run, "bucket int, lang string, hashes binary, counts binary, phrases binary")
    return found.repartition(buckets, "bucket").mapInArrow(chosen, "lang string, phrase string")


def _packed(
    lang: bytes, words: Words, keys: np.ndarray, counts: np.ndarray, size: int, buckets: int
) -> Iterator[pa.RecordBatch]:
    """The phrases in one row per bucket: hashes, counts, and phrases ending in a newline."""
    codes = [(keys >> (_SHIFT * k)) & ((1 << _SHIFT) - 1) for k in reversed(range(size))]
    hashed = np.full(len(keys), xxh64_intdigest(lang), np.uint64)
    for some in codes:
        hashed = _mixed(hashed, words.hashes()[some])
    bucket = ((hashed >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
    kind = pa.large_binary()
    names, last = pa.array(words.names, kind), pa.array([w + b"\n" for w in words.names], kind)
    first = 0
    while first < buckets:
        # some buckets at a time
        until = max(first + 1, int(np.searchsorted(bounds, bounds[first] + SENT, "right")) - 1)
        part = order[bounds[first] : bounds[until]]
        if len(part):
            columns = [names.take(pa.array(some[part])) for some in codes[:-1]]
            joined = pc.binary_join_element_wise(*columns, last.take(pa.array(codes[-1][part])), pa.scalar(b" ", kind))
            # the phrases stand one after the other in the column's memory, with where each begins
            _, begins, letters = joined.buffers()
            ends = np.frombuffer(begins, np.int64, len(part) + 1, 8 * joined.offset)
            text = memoryview(letters)  # its slices are copied: Arrow never lets go of a view that it is given
            own = [k for k in range(first, until) if bounds[k] < bounds[k + 1]]
            cuts = [(bounds[k] - bounds[first], bounds[k + 1] - bounds[first]) for k in own]
            h, c = hashed[part], counts[part]
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(own, pa.int32()),
                    "lang": pa.array([lang] * len(own), pa.binary()).cast(pa.string()),
                    "hashes": pa.array([h[a:b].tobytes() for a, b in cuts], pa.binary()),
                    "counts": pa.array([c[a:b].tobytes() for a, b in cuts], pa.binary()),
                    "phrases": pa.array([text[ends[a] : ends[b]].tobytes() for a, b in cuts], pa.binary()),
                }
            )
        first = until


def double_array(paths: np.ndarray, lengths: np.ndarray, radix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base``, ``check`` and ``accept`` of a trie of rows of ``paths``, digits below ``radix``.

    The root is state 0. From state s a digit d leads to ``base[s] + d`` if ``check`` there is s.
    ``accept`` has the number of the row that ends in a state, or -1. All nodes of a round try a
    place at random; a node stays if its places are free and no larger node wants one of them.
    """
    node = np.zeros(len(paths), np.int64)
    accept_of = [np.full(1, -1, np.int64)]
    parents, digits, total = [], [], 1
    for level in range(paths.shape[1]):
        active = np.flatnonzero(lengths > level)
        if not len(active):
            break
        keys, where = np.unique(node[active] * radix + paths[active, level], return_inverse=True)
        parents.append(keys // radix)
        digits.append(keys % radix)
        node[active] = total + where
        total += len(keys)
        ended = np.full(len(keys), -1, np.int64)
        ends = np.flatnonzero(lengths[active] == level + 1)
        ended[where[ends]] = active[ends]
        accept_of.append(ended)
    if not parents:
        return np.zeros(radix + 1, np.int32), np.full(radix + 1, -1, np.int32), np.full(radix + 1, -1, np.int32)
    parent, digit, accepts = np.concatenate(parents), np.concatenate(digits), np.concatenate(accept_of)
    begins = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
    counts = np.diff(np.r_[begins, len(parent)])
    rng = np.random.default_rng(1)
    base_of = np.zeros(total, np.int64)
    pending = np.argsort(-counts, kind="stable")
    low, taken = 1, np.ones(1, bool)
    while len(pending):
        room = max(radix, 2 * int(counts[pending].sum()))
        taken = np.r_[taken, np.zeros(low + room + radix - len(taken), bool)]
        claims = np.full(len(taken), len(pending), np.int64)
        for _ in range(24):
            if not len(pending):
                break
            own = counts[pending]
            places = rng.integers(low, low + room, len(pending))
            starts = np.r_[0, np.cumsum(own)[:-1]]
            rank = np.repeat(np.arange(len(pending)), own)
            edges = np.repeat(begins[pending] - starts, own) + np.arange(len(rank))
            slots = places[rank] + digit[edges]
            free = np.logical_and.reduceat(~taken[slots], starts)
            wanted = free[rank]
            claims[slots[wanted][::-1]] = rank[wanted][::-1]  # the first, so the largest, is written last
            good = free & np.logical_and.reduceat(claims[slots] == rank, starts)
            taken[slots[good[rank]]] = True
            claims[slots] = len(pending)
            base_of[parent[begins[pending[good]]]] = places[good]
            pending = pending[~good]
        low = len(taken) - radix
    slot_of = np.zeros(total, np.int64)
    slot_of[1:] = base_of[parent] + digit
    size = int(slot_of.max()) + 1 + radix
    base, check, accept = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    base[slot_of] = base_of
    check[slot_of[1:]] = slot_of[parent]
    accept[slot_of] = accepts
    return base, check, accept


def _build(table: pa.Table) -> pa.Table:
    """One trie as one row: languages, words, the number of digits' values and the arrays."""
    table = table.combine_chunks()
    by_lang = pc.dictionary_encode(table.column("lang").chunk(0).cast(pa.binary()))
    langs, lang_of = by_lang.dictionary.to_pylist(), by_lang.indices.to_numpy()
    split = pc.split_pattern(table.column("phrase").chunk(0), " ")
    sizes = split.value_lengths().to_numpy()
    by_word = pc.dictionary_encode(split.flatten().cast(pa.binary()))
    codes, names = by_word.indices.to_numpy(), by_word.dictionary.to_pylist()
    del split
    radix = max(2, int(np.ceil(np.sqrt(max(len(names), len(langs)) + 1))))
    grid = np.zeros((len(sizes), 1 + LONGEST), np.int32)
    grid[:, 0] = lang_of
    ends = np.cumsum(sizes)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    grid[rows, 1 + np.arange(len(rows)) - np.repeat(ends - sizes, sizes)] = codes
    paths = np.stack([grid // radix, grid % radix], axis=2).reshape(len(sizes), -1)
    base, check, accept = double_array(paths, 2 * (sizes + 1), radix)
    accept[accept >= 0] = table.column("number").to_numpy()[accept[accept >= 0]]
    return pa.table(
        {
            "trie": pa.array([table.column("trie")[0].as_py()], pa.int64()),
            "radix": pa.array([radix], pa.int64()),
            "langs": pa.array([langs], pa.list_(pa.binary())),
            "words": pa.array([b"\n".join(names)], pa.binary()),
            "base": pa.array([base.tobytes()], pa.binary()),
            "check": pa.array([check.tobytes()], pa.binary()),
            "accept": pa.array([accept.tobytes()], pa.binary()),
        }
    )


_TRIE_ROW = "trie long, radix long, langs array<binary>, words binary, base binary, check binary, accept binary"


class Trie:
    """A trie read back from its row."""

    def __init__(self, row: dict):
        self.radix = row["radix"]
        self.base, self.check, self.accept = (np.frombuffer(row[c], np.int32) for c in ("base", "check", "accept"))
        self.size = int(self.accept.max(initial=-1)) + 1
        names = bytes(row["words"]).split(b"\n")
        self.code = {word: k for k, word in enumerate(names)}
        every = np.arange(len(names))
        #: By language, the state after each word at a phrase's begin, -1 for none.
        self.first: dict[bytes, np.ndarray] = {}
        for k, lang in enumerate(row["langs"]):
            at, states = self.advance(np.zeros(1, np.int64), np.array([k]))
            begun = np.full(len(names) + 1, -1, np.int64)
            kept, reached = self.advance(np.full(len(names), states[0]), every)
            begun[kept] = reached
            self.first[bytes(lang)] = begun

    def advance(self, states: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the states go on with their codes, and where they get to."""
        kept = np.arange(len(states))
        for digits in (codes // self.radix, codes % self.radix):
            following = self.base[states] + digits[kept]
            good = self.check[following] == states
            kept, states = kept[good], following[good]
        return kept, states

    def count(self, lang: bytes, tokens: pa.Array, counts: np.ndarray) -> None:
        """Add the occurrences of all phrases among the words to ``counts``."""
        begun = self.first.get(lang)
        if begun is None or not len(tokens):
            return
        codes = _looked_up(lambda word: self.code.get(word, -1), tokens)
        states = begun[codes]  # the last one, of no word, is -1
        at = np.flatnonzero(states >= 0)
        states = states[at]
        for k in range(1, LONGEST):
            ahead = at + k
            good = ahead < len(codes)
            good[good] = codes[ahead[good]] >= 0
            at, states = at[good], states[good]
            kept, states = self.advance(states, codes[at + k])
            at = at[kept]
            ends = self.accept[states]
            counts += np.bincount(ends[ends >= 0], minlength=self.size)


def _counted(plain: DataFrame, row: dict) -> DataFrame:
    shared = plain.sparkSession.sparkContext.broadcast(row)
    which = row["trie"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(shared.value)
        counts = np.zeros(trie.size, np.int64)
        for batch in batches:
            for lang, tokens in token_lists(batch):
                trie.count(lang, tokens, counts)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(found), which, np.int64)), pa.array(found), pa.array(counts[found])],
            ["trie", "number", "n"],
        )

    return plain.mapInArrow(run, "trie long, number long, n long")


def phrase_counts(plain: DataFrame, wanted: DataFrame, trie_size: int = TRIE) -> DataFrame:
    """``(lang, phrase, f)``: how often each phrase of ``wanted(lang, phrase)``, distinct and of
    two to ``LONGEST`` words, occurs."""
    tries = max(1, -(-wanted.count() // trie_size))
    dealt = wanted.withColumn("trie", F.pmod(F.xxhash64("lang", "phrase"), F.lit(tries)))
    order = Window.partitionBy("trie").orderBy("lang", "phrase")
    numbered = materialize(dealt.withColumn("number", F.row_number().over(order).cast("long") - 1), "phrase_numbers")
    built = materialize(numbered.groupBy("trie").applyInArrow(_build, _TRIE_ROW), "phrase_tries")
    found = None
    for which in range(tries):
        row = built.where(F.col("trie") == which).toArrow().to_pylist()
        if row:
            part = _counted(plain, row[0]).groupBy("trie", "number").agg(F.sum("n").alias("f"))
            part = materialize(part, "phrase_sums")
            found = part if found is None else found.union(part)
    if found is None:
        return wanted.select("lang", "phrase", F.lit(0).cast("long").alias("f"))
    return numbered.join(found, ["trie", "number"]).select("lang", "phrase", "f")


def _first(scored: DataFrame, top: int) -> DataFrame:
    """Each language's first rows with their rank. Groups' first ones are taken before, so that
    no task ranks all phrases of a language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for salts in SALTS:
        group = F.pmod(F.xxhash64("phrase"), F.lit(salts))
        scored = (
            scored.withColumn("group", group)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "group").orderBy(*order)))
            .where(F.col("rank") <= top)
            .drop("rank", "group")
        )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return scored.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)


def collocations(
    docs: DataFrame, least: int = LEAST, covered: int = COVERED, top: int = TOP, longest: int = LONGEST
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases of two to
    ``longest`` (at most 3) words that occur ``least`` times or more.

    ``score`` is floor(10**6 a a / (l r)) for the cut with the least score. Phrases inside a longer
    one that makes up ``covered`` percent of their occurrences are left out.
    """
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have two to {LONGEST} words")
    plain = small_batches(by_language(docs))
    words = materialize(word_counts(plain), "phrase_words")
    frequent = words.where(F.col("f") >= least)
    total = words.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    buckets = max(docs.sparkSession.sparkContext.defaultParallelism, -(-total // BUCKET_WORDS))
    levels = [frequent.select("lang", "phrase")]
    for size in range(2, longest + 1):
        levels.append(materialize(candidates(plain, levels[-1], size, least, buckets), "phrase_candidates"))
    wanted = levels[1]
    for level in levels[2:]:
        wanted = wanted.union(level)
    counts = materialize(phrase_counts(plain, wanted), "phrase_counts")
    return ranked(counts, frequent, words.groupBy("lang").agg(F.sum("f").alias("n")), covered, top)


def ranked(counts: DataFrame, words: DataFrame, totals: DataFrame, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """Scores, containment and ranks from the counts of phrases and of words."""
    split = counts.withColumn("w", F.split("phrase", " ", -1))
    inner = (
        split.where(F.size("w") > 2)
        .select("lang", "f", F.explode(F.expr(
            "flatten(transform(sequence(2, size(w) - 1), k -> transform(sequence(1, size(w) - k + 1), i -> slice(w, i, k))))"
        )).alias("part"))
        .groupBy("lang", F.array_join("part", " ").alias("phrase"))
        .agg(F.max("f").alias("longer"))
    )
    kept = split.join(inner, ["lang", "phrase"], "left").where(
        F.expr(f"coalesce(100 * longer < {int(covered)} * f, true)")
    )
    cuts = kept.select(
        "lang", "phrase", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"), "w"
    ).select(
        "lang", "phrase", "a", "k",
        F.expr("array_join(slice(w, 1, k), ' ')").alias("first"),
        F.expr("array_join(slice(w, k + 1, size(w) - k), ' ')").alias("rest"),
    )
    known = words.select("lang", "phrase", "f").union(counts.select("lang", "phrase", "f"))
    joined = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(
        known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]
    )
    exact = F.expr(
        "(1000000BD * (cast(a as decimal(16,0)) * cast(a as decimal(16,0))))"
        " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    )
    lowest = (
        joined.withColumn("score", exact)
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("cut"))
        .select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score")
    )
    return _first(lowest, top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
