"""SimHash fingerprints and their near duplicates by ball hashing.

Two fingerprints at most two bits apart have a common variant at most one bit from each.
So every distinct fingerprint emits itself and its 64 one-bit variants, rows meet on the
variant, and neighbours in a variant's list are linked. A list holds at most 65 distinct
fingerprints, whatever the data: copies of a text are one fingerprint before the shuffle.

``keep_one`` keeps one document of each component.

Null texts and texts without words have fingerprint zero and are linked like any others. Repeated rows are rows of one
fingerprint. A null id is never the smallest id of a component unless all are null. Extra columns are
kept by ``keep_one``, whatever their names, and are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from ..sources.scratch import materialize
from .common import small_batches, space_words, texts, unused
from .components import components

SEED = 42
SHINGLE = 3
#: Bits of each byte value, lowest first.
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
#: Nothing, or one bit of a signed 64-bit number.
_FLIPS = [0, *(1 << i for i in range(63)), -(1 << 63)]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of one text in UTF-8."""
    words = space_words(text)
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8")
    parts = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.stack([np.bincount(parts[:, i], minlength=256) for i in range(8)]) @ _BITS
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, text_key, fp)`` for every row of documents; the key is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(found, pa.int64())],
                ["doc_id", "text_key", "fp"],
            )

    keyed = texts(docs).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return small_batches(keyed).mapInArrow(run, "doc_id long, text_key long, fp long")


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Edges ``(a, b)`` that connect all ``fp`` within ``radius`` (2) bits of each other."""
    if radius != 2:
        raise ValueError("the ball of half the radius is built for a radius of 2")
    variants = distinct.select(
        "fp",
        F.explode(F.transform(F.lit(_FLIPS), lambda flip: F.col("fp").bitwiseXOR(flip))).alias("variant"),
    )
    meeting = Window.partitionBy("variant").orderBy("fp")
    return (
        variants.select(F.lag("fp").over(meeting).alias("a"), F.col("fp").alias("b"))
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).between(1, radius))
        .distinct()
    )


def near_duplicates(prints: DataFrame) -> DataFrame:
    """The stored rows of ``prints`` with ``root``, a fingerprint that names the component,
    and ``component_id``, the smallest ``doc_id`` in it."""
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fp_classes")
    linked = materialize(
        components(links(classes.select("fp"))).select(F.col("node").alias("fp"), "root"), "fp_roots"
    )
    rooted = materialize(
        classes.join(linked, "fp", "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root")),
        "fp_rooted",
    )
    least = materialize(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "fp_least")
    named = materialize(rooted.join(least, "root").select("fp", "root", "component_id"), "fp_components")
    return prints.join(named, "fp")


def simhash_duplicates(docs: DataFrame) -> DataFrame:
    """Fingerprint and component of every document row."""
    found = near_duplicates(materialize(fingerprints(docs), "fingerprints"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each component of near duplicates one document: the one with the smallest id.

    Rows without an id come after all others; among rows of one id the smallest hash of the
    text decides, and of rows repeated with id and text one stays.
    """
    found = near_duplicates(materialize(fingerprints(docs), "fingerprints"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")).alias("first")
    key, kept_id, kept_key = unused(docs, "text_key", "kept_id", "kept_key")
    kept = found.groupBy("root").agg(first).select(
        F.col("first.doc_id").alias(kept_id), F.col("first.text_key").alias(kept_key)
    )
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id)) & (F.col(key) == F.col(kept_key))
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", key]).select(*docs.columns)
