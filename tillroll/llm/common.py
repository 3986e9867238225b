"""What the operators of this subpackage share: columns, folds and word caches."""

from __future__ import annotations

from collections.abc import Callable, Hashable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Lower-case A-Z and turn every other ASCII character outside 0-9 and a-z into a space.
_WORD_BYTES = bytes(
    c if c >= 128 or chr(c).isalnum() else 32 for c in (ord(chr(i).lower()) if i < 128 else i for i in range(256))
)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(frame: DataFrame) -> DataFrame:
    """The frame, whose session now hands 1,000 rows at a time to Python, unless it has a
    setting of its own: the usual 10,000 whole texts are much to hold several times over."""
    conf = frame.sparkSession.conf
    if conf.get(_BATCH, None) is None:
        conf.set(_BATCH, "1000")
    return frame


def texts(docs: DataFrame) -> DataFrame:
    """The id and the text alone, a null text as the empty one."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def unused(frame: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores behind it until no column of the frame is called so."""
    taken = {c.lower() for c in frame.columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        free.append(name)
    return free


def id_remainder(divisor: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    as_text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % divisor


def space_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased."""
    return text.lower().split()


def letter_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.translate(_WORD_BYTES).split()


class Memo(dict):
    """A cache of at most about ``2 * size`` results; what was used lately stays.

    Entries live in two generations. A full young generation becomes the old one, and an
    old entry that is asked for again is carried over.
    """

    def __init__(self, compute: Callable, size: int = 200_000):
        super().__init__()
        self._compute, self._size, self._old = compute, size, {}

    def forget(self) -> None:
        """Give the memory back; workers are used again for other stages."""
        self.clear()
        self._old = {}

    def __missing__(self, key: Hashable):
        if len(self) >= self._size:
            self._old = dict(self)
            self.clear()
        value = self._old.get(key)
        if value is None:
            value = self._compute(key)
        self[key] = value
        return value
