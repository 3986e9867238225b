"""Language of texts by compression: the language whose dictionary makes a text smallest.

A language's dictionary is raw content for zstandard: text pieces of the language, and after them its
commonest words. Texts are compressed in pieces of ``CHUNK`` bytes with each dictionary; the
sizes add up. The share of a language is its part of the sum of 2**(-size / ``BYTES``) over all
languages. A text is accepted if the next best size is larger by ``MARGIN`` of the smallest.

Dictionaries are fitted on a bounded sample: ``SAMPLE`` texts a language, fewer where there are over 128
languages, a piece of ``PIECE`` characters of each; texts are drawn by their hash, so copies count once. More than
``LANGUAGES`` languages are refused. Every text is scored whole.

Texts without a letter, null and empty ones are ``und`` with score 0, so is every text if there is nothing to
learn from. Of equal sizes the language that comes first in byte order counts. Repeated rows have rows of their
own. Language, source and id are not read where texts are scored; extra columns never.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from .common import id_remainder, small_batches

FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
SAMPLE, PIECE = 256, 1000
LANGUAGES = 4096
#: Bytes of a dictionary, and of its common words; bytes of all dictionaries.
CONTENT, COMMON, ALL_CONTENT = 32_000, 8_000, 16 << 20
CHUNK = 8192
#: Bytes up to which a shorter text is repeated.
SHORT = 256
LEVEL = 6
#: Bytes that halve a language's share; least lead of the best language.
BYTES = 4.0
MARGIN = 0.01

#: Every ASCII character that is no letter becomes a space, A-Z are lower-cased.
_LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_LETTER = r"\p{L}"


def plain(text: bytes) -> bytes:
    """Letters and single spaces."""
    return b" ".join(text.translate(_LETTERS).split())


def _parameters() -> zstandard.ZstdCompressionParameters:
    return zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=CHUNK, dict_size=CONTENT, write_content_size=False, write_checksum=False, write_dict_id=False
    )


def dictionary(pieces: list[bytes], size: int = CONTENT) -> bytes:
    """Raw content of at most about ``size`` bytes: parts of all pieces, then the commonest words, the
    most frequent one last, where zstandard finds it at the least cost."""
    counts = Counter(word for piece in pieces for word in piece.split())
    common, left = [], size * COMMON // CONTENT
    for word, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        left -= len(word) + 1
        if left < 0:
            break
        common.append(word)
    prose = size - size * COMMON // CONTENT
    each = max(1, prose // max(1, len(pieces)))
    return b" ".join([*(piece[:each] for piece in pieces), *reversed(common), b""])


def learned(training: DataFrame, sample: int = SAMPLE) -> dict[str, bytes]:
    """The dictionary of every language of ``training(text, lang)``, both not null, texts with letters."""
    spark = training.sparkSession
    hashed = training.select("lang", "text", F.xxhash64("text").alias("h"))
    sizes = hashed.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n"))
    sizes = sizes.limit(LANGUAGES + 1).collect()
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not sizes:
        return {}
    sample = max(8, min(sample, SAMPLE * 128 // len(sizes)))
    rates = spark.createDataFrame(
        [(r["lang"], min(1.0, 2.0 * sample / r["n"])) for r in sizes], "lang string, rate double"
    )
    share = F.pmod(F.xxhash64("h"), F.lit(1 << 30)) / (1 << 30)
    begin = F.pmod(F.xxhash64("h", F.lit(1)), F.greatest(F.lit(1), F.length("text") - PIECE)).cast("int") + 1
    drawn = (
        hashed.join(F.broadcast(rates), "lang")  # at most LANGUAGES rows
        .where(share < F.col("rate"))
        .select("lang", "h", F.col("text").substr(begin, F.lit(PIECE)).alias("piece"))
        .dropDuplicates(["lang", "h"])
    )
    order = Window.partitionBy("lang").orderBy(F.xxhash64("h"), "piece")
    rows = drawn.withColumn("k", F.row_number().over(order)).where(F.col("k") <= sample)
    pieces: dict[str, list[bytes]] = {}
    for row in rows.select("lang", "k", "piece").orderBy("lang", "k").collect():
        pieces.setdefault(row["lang"], []).append(plain(row["piece"].encode()))
    size = min(CONTENT, ALL_CONTENT // len(pieces)) if pieces else CONTENT
    return {lang: dictionary(own, size) for lang, own in sorted(pieces.items(), key=lambda x: x[0].encode())}


class Compressors:
    """One compressor a language."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = list(dictionaries)
        parameters = _parameters()
        self._by = []
        for content in dictionaries.values():
            if len(content) < 8:  # less is no dictionary to zstandard
                self._by.append(zstandard.ZstdCompressor(compression_params=parameters))
                continue
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=parameters)
            self._by.append(zstandard.ZstdCompressor(compression_params=parameters, dict_data=held))

    def sizes(self, text: bytes) -> np.ndarray:
        """Bytes of the text by each language's dictionary; short texts are repeated, as too small a gain
        makes zstandard store them raw."""
        if text and len(text) < SHORT:
            text = b" ".join([text] * (SHORT // len(text) + 1))
        parts = [text[at : at + CHUNK] for at in range(0, len(text), CHUNK)]
        return np.array([sum(map(len, map(by.compress, parts))) for by in self._by], np.int64)

    def verdict(self, text: bytes) -> tuple[str, float, bool]:
        """Best language, its share, and whether its lead is wide enough."""
        sizes = self.sizes(text)
        best = int(sizes.argmin())
        share = 1 / np.exp2((sizes[best] - sizes) / BYTES).sum()
        others = np.delete(sizes, best)
        wide = not len(others) or others.min() - sizes[best] >= max(1, MARGIN * sizes[best])
        return self.langs[best], float(share), bool(wide)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``lang_pred``, ``score``, ``accepted`` of every row's ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Compressors(shared.value)
        for batch in batches:
            langs, scores, accepted = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                told = (UNKNOWN, 0.0, False) if text is None or not by.langs else by.verdict(plain(text))
                for values, value in zip((langs, scores, accepted), told):
                    values.append(value)
            own = [batch.column(c) for c in keep]
            found = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*own, *found], [*keep, "lang_pred", "score", "accepted"])

    text = F.col("text").cast("string")
    wanted = docs.select(*keep, F.when(text.rlike(_LETTER), text).alias("text"))
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.drop("text").schema)
    return small_batches(wanted).mapInArrow(run, f"{types}, lang_pred string, score double, accepted boolean")


def language_of(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, accepted)`` of every document, learnt from the
    documents outside the held-out fold. ``lang_pred`` is given for narrow leads too;
    ``accepted`` is false there."""
    held_out = id_remainder(FOLDS) == HELD_OUT
    text = F.col("text").cast("string")
    training = docs.where(~held_out & F.col("lang").isNotNull() & text.rlike(_LETTER)).select(
        text.alias("text"), F.col("lang").cast("string").alias("lang")
    )
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    found = identify(kept, learned(training), ("doc_id", "held_out"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def rejected_as_unknown(found: DataFrame) -> DataFrame:
    """``language_of``'s rows, with ``und`` where the lead is too narrow."""
    return found.withColumn("lang_pred", F.when(F.col("accepted"), F.col("lang_pred")).otherwise(UNKNOWN))
