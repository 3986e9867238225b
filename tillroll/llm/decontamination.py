"""Benchmark items inside documents: containment search by size-partitioned MinHash.

Items are grouped by their number of five-word shingles into classes (16, 32, 64 ...). A whole
document would dilute a short item, so for each class documents are cut into overlapping
windows of one and a half times the class's size, half a class apart: a passage of the class
lies in one window as a whole, and makes up a good part of it. Items and windows get ``HASHES``
minima, and a window is a candidate for an item with which it shares one of them (one row per
band: at the least similarity that a passage of more than ``SHORT`` shingles can have in its
window, 0.25, all 48 minima differ in one case of a million). Minima of windows are put together from those of their blocks.

In such a window a passage of few shingles would be too small a part. Items of up to ``SHORT``
shingles are looked up by shingles instead: of n shingles a document with a share of ``THRESHOLD`` of
them lacks so few that it has one of any choice of one more than these.

A window can only share a minimum that is the hash of one of its own shingles. So the shingles
that are minima of items are set in a bitmap, and documents without any of them need no minima.
The bitmap has a fixed size (``BITS``) whatever the number of items; it may let too much through,
which the join on the minima then decides, but holds nothing back. Candidate pairs are verified: the share of the item's distinct shingles
that stand anywhere in the document, compared as words, at least ``THRESHOLD``.

Words are those of ``letter_words``. A text of fewer than five words is one shingle, a text
without words has none and matches nothing. Null texts are empty. Rows without an id are
searched like others. Repeated documents and items give repeated rows once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from ..sources.scratch import materialize
from .common import Memo, letter_words, texts, unused

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 48
LEAST_CLASS = 16
#: Items of at most so many shingles have no minima; they are a class of their own.
SHORT = 8
#: Bits of the map of item shingles; 2 MB.
BITS = 1 << 24
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_random = np.random.default_rng(5)
_WORD_FACTORS = _random.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _random.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = _random.integers(1, 1 << 63, HASHES, dtype=np.uint64)


def shingle_hashes(words: list[bytes], word_hash) -> np.ndarray:
    """A 64-bit hash of each shingle in order."""
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(word_hash, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    mixed = np.full(n, np.uint64(width), np.uint64)
    for i in range(width):
        mixed += hashes[i : i + n] * _WORD_FACTORS[i]
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def size_class(n: int) -> int:
    """The smallest class that holds ``n`` shingles."""
    if n <= SHORT:
        return SHORT
    size = LEAST_CLASS
    while size < n:
        size *= 2
    return size


def _minima(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each run of ``hashes`` beginning at ``starts``, the hashes that come first in each order."""
    out = np.empty((HASHES, len(starts)), np.uint64)
    for k in range(HASHES):
        out[k] = np.minimum.reduceat((hashes ^ _SALTS[k]) * _FACTORS[k], starts)
    return out


def _keys(minima: np.ndarray, size: int) -> np.ndarray:
    """Minima with their order and class mixed in, so that only like is compared."""
    salt = _SALTS[:, None] + np.uint64(size)
    return (minima ^ salt) * np.uint64(0x9E3779B97F4A7C15)


def _bit(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) & (BITS - 1)


def least_shingles(hashes: np.ndarray) -> np.ndarray:
    """The hashes that are first in any of the orders."""
    return np.unique([hashes[np.argmin((hashes ^ s) * f)] for s, f in zip(_SALTS, _FACTORS)])


def _looked_up(hashes: np.ndarray, threshold: float) -> np.ndarray:
    """So many of an item's shingles that a document which contains it has one of them."""
    needed = max(1, int(np.ceil(threshold * len(hashes) - 1e-9)))
    return hashes[: len(hashes) - needed + 1]


def item_rows(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(item_id, item_key, size, text, keys, firsts)`` of items with words, repeated ones once:
    the minima as compared, and the hashes of the shingles they come from; of short items the
    shingles to look up as both."""
    found = items.select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hash = Memo(lambda w: xxh64_intdigest(w, 7))
        for batch in batches:
            out = []
            rows = zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist())
            for item_id, text in rows:
                hashes = np.unique(shingle_hashes(letter_words(text.encode()), word_hash.__getitem__))
                if len(hashes):
                    size = size_class(len(hashes))
                    if size == SHORT:
                        keys = firsts = _looked_up(hashes, threshold)
                    else:
                        keys = _keys(_minima(hashes, np.array([0])), size)[:, 0]
                        firsts = least_shingles(hashes)
                    out.append(
                        (
                            item_id,
                            zlib.crc32(text.encode()),
                            size,
                            text,
                            keys.astype(np.int64).tolist(),
                            firsts.astype(np.int64).tolist(),
                        )
                    )
            if out:
                names = ["item_id", "item_key", "size", "text", "keys", "firsts"]
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[i] for r in out], kind)
                        for i, kind in enumerate(
                            (pa.int64(), pa.int64(), pa.int64(), pa.string(), longs, longs)
                        )
                    ],
                    names,
                )

    return found.mapInArrow(
        run, "item_id long, item_key long, size long, text string, keys array<long>, firsts array<long>"
    )


def key_bitmap(items: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The bitmap of all items' least shingles, and the classes that occur.

    The driver gets one row per 32 bits of the map at most.
    """
    firsts = items.select(F.explode("firsts").alias("first"))
    bits = firsts.select(F.shiftrightunsigned("first", 40).bitwiseAND(BITS - 1).alias("bit"))
    one = F.expr("shiftleft(1L, cast(bit & 31 AS int))")
    packed = bits.groupBy(F.shiftright("bit", 5).alias("word")).agg(F.bit_or(one).alias("bits")).collect()
    bitmap = np.zeros(BITS // 32, np.uint32)
    for row in packed:
        bitmap[row["word"]] = row["bits"]
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    return bitmap, sizes


def window_keys(hashes: np.ndarray, sizes: list[int]) -> np.ndarray:
    """The keys of all windows of a document, for each class."""
    found = []
    step = LEAST_CLASS // 2
    minima = _minima(hashes, np.arange(0, len(hashes), step))
    blocks = {step: minima}
    for size in sizes:
        half = size // 2
        width = max(blocks)
        while width < half:
            wide = blocks[width]
            if wide.shape[1] % 2:
                wide = np.concatenate([wide, np.full((HASHES, 1), _NONE)], axis=1)
            blocks = {width * 2: np.minimum(wide[:, ::2], wide[:, 1::2])}
            width *= 2
        wide = blocks[half]
        windows = wide
        for i in (1, 2):
            if wide.shape[1] > i:
                windows = windows.copy() if windows is wide else windows
                windows[:, :-i] = np.minimum(windows[:, :-i], wide[:, i:])
        found.append(_keys(windows, size).ravel())
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


def candidate_keys(docs: DataFrame, bitmap: np.ndarray, sizes: list[int]) -> DataFrame:
    """``(doc_id, text_key, key)``: the window minima of each document with a known shingle that
    are minima of such a shingle, and the known shingles themselves if there are short items."""
    wide = [s for s in sizes if s > SHORT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hash = Memo(lambda w: xxh64_intdigest(w, 7))
        for batch in batches:
            rows, keys = [], []
            for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                hashes = shingle_hashes(letter_words(text), word_hash.__getitem__)
                bits = _bit(hashes)
                known = hashes[(bitmap[bits >> 5] >> (bits & 31).astype(np.uint32)) & 1 == 1]
                if len(known):
                    known = np.unique(known)
                    own = known if SHORT in sizes else known[:0]
                    if wide:
                        # of all window minima those that a known shingle can be
                        able = np.concatenate(
                            [_keys((known ^ _SALTS[:, None]) * _FACTORS[:, None], s).ravel() for s in wide]
                        )
                        own = np.union1d(own, np.intersect1d(window_keys(hashes, wide), able))
                    if len(own):
                        rows.append(np.full(len(own), i))
                        keys.append(own)
            if rows:
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(at),
                        batch.column("text_key").take(at),
                        pa.array(np.concatenate(keys).astype(np.int64)),
                    ],
                    ["doc_id", "text_key", "key"],
                )

    return docs.mapInArrow(run, "doc_id long, text_key long, key long")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared, total = [], []
        for text, item in zip(batch.column("text").to_pylist(), batch.column("item_text").to_pylist()):
            own = shingles(item)
            total.append(len(own))
            shared.append(len(own & shingles(text)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), batch.column("item_id"), pa.array(total), pa.array(shared)],
            ["doc_id", "text_key", "item_id", "n_shingles", "n_shared"],
        )


def shingles(text: str) -> set[bytes]:
    words = letter_words(text.encode())
    if not words:
        return set()
    width = min(SHINGLE, len(words))
    return set(map(b" ".join, zip(*(words[i:] for i in range(width)))))


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, text_key, item_id, n_shingles, n_shared, containment)`` per verified pair."""
    stored = materialize(item_rows(items, threshold), "benchmark_items")
    bitmap, sizes = key_bitmap(stored)
    keyed = texts(docs).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    found = materialize(candidate_keys(keyed, bitmap, sizes), "benchmark_keys")
    keys = stored.select("item_id", "item_key", F.explode("keys").alias("key"))
    pairs = materialize(
        found.join(keys, "key").select("doc_id", "text_key", "item_id", "item_key").distinct(), "benchmark_pairs"
    )
    # the texts of candidates only, each document once
    wanted = pairs.select(F.col("doc_id").alias("wanted_id"), F.col("text_key").alias("wanted_key")).distinct()
    match = F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.col("text_key") == F.col("wanted_key"))
    candidates = materialize(keyed.join(wanted, match, "left_semi").distinct(), "benchmark_documents")
    pair_ids = pairs.withColumnsRenamed({"doc_id": "wanted_id", "text_key": "wanted_key"})
    item_texts = stored.select(F.col("item_id").alias("of_item"), F.col("item_key").alias("of_key"), F.col("text").alias("item_text"))
    joined = (
        pair_ids.join(item_texts, F.col("item_id").eqNullSafe(F.col("of_item")) & (F.col("item_key") == F.col("of_key")))
        .join(candidates, match)
        .select("doc_id", "text_key", "item_id", "text", "item_text")
    )
    checked = joined.mapInArrow(
        _verified, "doc_id long, text_key long, item_id long, n_shingles long, n_shared long"
    )
    containment = F.col("n_shared") / F.col("n_shingles")
    return checked.withColumn("containment", containment).where(containment >= threshold)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and item that it contains."""
    return contained_items(docs, items).select("doc_id", "item_id", "n_shingles", "n_shared", "containment").distinct()


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that contain no item."""
    hit_id, hit_key = unused(docs, "hit_id", "hit_key")
    hits = contained_items(docs, items).select(
        F.col("doc_id").alias(hit_id), F.col("text_key").alias(hit_key)
    ).distinct()
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    match = F.col("doc_id").cast("long").eqNullSafe(F.col(hit_id)) & (key == F.col(hit_key))
    return docs.join(materialize(hits, "benchmark_hits"), match, "left_anti")
