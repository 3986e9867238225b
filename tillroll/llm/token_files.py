"""Token ids in binary files: frequency ranks in 1 to 4 bytes, control bytes apart.

``encode_documents`` turns texts into ids, ``rank_table`` counts them over all documents and
ranks them (rank 0 is the most frequent id), ``write_files`` writes the ranks in ascending
document order and ``read_files`` decodes the files again.

A file is a row of blocks of whole documents. A block is ``<4sIQQ`` (mark, documents, values,
data bytes), the document ids as int64, a byte per document that is 1 where its id is null,
the lengths as uint32, then the control bytes and the data bytes. Each control byte holds the
number of bytes less one of four values, two bits each, lowest bits first; a value's bytes
follow each other in the data, lowest first. The decoder looks the four sizes of a control
byte up in a table, sums them to positions and gathers the bytes of all values at once.

Documents with null ids come first, documents that share an id follow each other in the
order of the crc32 of their ids. A null or empty text has the end id alone. Every writing
attempt has a file name of its own, and the manifest names the files of finished tasks only.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from ..sources.scratch import materialize, scratch_folder
from .common import Memo, small_batches, texts

MARK = b"TRF1"
HEAD = "<4sIQQ"
#: Signs that the library may compose, or give other small forms than a letter below U+0180.
OTHERS = re.compile("[İƀ-\U0010ffff]")
#: The library's pieces of small text without such signs; figures, which it takes one by one, in runs.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ſ]+|[0-9²³¹¼-¾]+|[^\sa-zªµºß-öø-ſ0-9²³¹¼-¾]+")
FIGURES = frozenset("0123456789²³¹¼½¾")
#: Pieces, and words with other signs, that a worker remembers, twice at most.
REMEMBERED, REMEMBERED_WORDS = 250_000, 50_000
#: Values of a block, if its first document has no more by itself.
BLOCK_VALUES = 1_000_000
#: Values a file should hold.
FILE_VALUES = 8_000_000
#: The number of bytes of each of the four values of a control byte.
SIZES = 1 + ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints,
    else the next one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


class WordTokenizer:
    """Ids of texts as the library gives them, piece by piece.

    No token of this kind of vocabulary spans two pieces of letters, figures or signs. Texts below U+0180
    are made small and cut by one pattern, and pieces are looked up in a cache; a new one goes straight to
    the library's model. Texts with other signs are looked up word by word; a new word with such signs
    takes the library's whole way unless it is of small letters in composed form. So does a text with special
    tokens or U+001C to U+001F.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.vocabulary = self.library.get_vocab_size()
        self.kind = np.dtype("<u2" if self.vocabulary < 65536 else "<u4")
        added = self.library.get_added_tokens_decoder().values()
        # the last four separate words for Python but not for the library
        self._special = [*(token.content for token in added), "\x1c", "\x1d", "\x1e", "\x1f"]
        self._letters = _byte_letters()
        self._packed = [i.to_bytes(self.kind.itemsize, "little") for i in range(self.vocabulary)]
        self._model = self.library.model
        self._pieces = Memo(self._piece, REMEMBERED)
        self._words = Memo(self._word, REMEMBERED_WORDS)

    def _whole(self, text: str) -> bytes:
        return b"".join([self._packed[i] for i in self.library.encode(text, add_special_tokens=False).ids])

    def _piece(self, piece: str) -> bytes:
        if len(piece) > 1 and piece[0] in FIGURES:
            return b"".join(map(self._pieces.__getitem__, piece))
        if not (piece.isascii() and piece.isprintable()):
            piece = "".join([self._letters[b] for b in piece.encode()])
        packed = self._packed
        return b"".join([packed[token.id] for token in self._model.tokenize(piece)])

    def _word(self, word: str) -> bytes:
        if not OTHERS.search(word):
            return self._simple(word)
        plain = word.isalpha() and word == "".join(map(str.lower, word))
        return self._piece(word) if plain and unicodedata.is_normalized("NFC", word) else self._whole(word)

    def _simple(self, text: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, PIECES.findall(text.lower())))

    def forget(self) -> None:
        self._pieces.forget()
        self._words.forget()

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self._special):
            return self._whole(text)
        if text.isascii() or not OTHERS.search(text):
            return self._simple(text)
        return b"".join(map(self._words.__getitem__, text.split()))


@lru_cache(maxsize=1)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def encode_documents(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """``(doc_id, ids, crc)``: ids as bytes of the vocabulary's width, the end id last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        end = np.array([end_id], own.kind).tobytes()
        for batch in batches:
            ids = [own.encode(t) + end for t in batch.column("text").to_pylist()]
            crc = [zlib.crc32(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(crc, pa.int64())],
                ["doc_id", "ids", "crc"],
            )
        own.forget()

    return small_batches(texts(docs)).mapInArrow(run, "doc_id long, ids binary, crc long")


def rank_table(encoded: DataFrame, vocabulary: int, kind: np.dtype) -> np.ndarray:
    """Ids by rank. One row per id of the vocabulary reaches the driver at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, np.int64)
        for batch in batches:
            ids = b"".join(batch.column("ids").to_pylist())
            counts += np.bincount(np.frombuffer(ids, kind), minlength=vocabulary)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["id", "n"])

    counted = encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    totals = np.zeros(vocabulary, np.int64)
    for row in counted.collect():
        totals[row["id"]] = row["n"]
    return np.argsort(-totals, kind="stable").astype(np.uint32)


def pack_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = values.astype(np.uint32)
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = extra
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    keep = np.arange(4) <= extra[:, None]
    data = values.astype("<u4").view(np.uint8).reshape(-1, 4)[keep]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of ``pack_values``."""
    sizes = SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    raw = np.frombuffer(data, np.uint8)
    values = raw[starts].astype(np.uint32)
    for i in range(1, 4):
        longer = np.flatnonzero(sizes > i)
        values[longer] |= raw[starts[longer] + i].astype(np.uint32) << np.uint32(8 * i)
    return values


def _blocks(ids: list[bytes], width: int) -> Iterator[slice]:
    begin = total = 0
    for i, one in enumerate(ids):
        n = len(one) // width
        if i > begin and total + n > BLOCK_VALUES:
            yield slice(begin, i)
            begin, total = i, 0
        total += n
    if begin < len(ids):
        yield slice(begin, len(ids))


def write_files(encoded: DataFrame, folder: str, ranked: np.ndarray, kind: np.dtype, values: int) -> DataFrame:
    """Write the stored ``encoded`` under ``folder``; the manifest, one row per file."""
    ranks = np.empty(len(ranked), np.uint32)
    ranks[ranked] = np.arange(len(ranked), dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        store, root = fs.FileSystem.from_uri(folder)
        name = f"{part:07d}-{uuid.uuid4().hex}.ids"
        out, n_docs, n_values = None, 0, 0
        for batch in batches:
            doc_ids, ids = batch.column("doc_id"), batch.column("ids").to_pylist()
            numbers = np.asarray(doc_ids.fill_null(0), dtype="<i8")
            nulls = np.asarray(doc_ids.is_null()).astype(np.uint8)
            for block in _blocks(ids, kind.itemsize):
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{root}/{name}")
                lengths = np.array([len(i) // kind.itemsize for i in ids[block]], "<u4")
                control, data = pack_values(ranks[np.frombuffer(b"".join(ids[block]), kind)])
                total = int(lengths.sum())
                out.write(struct.pack(HEAD, MARK, len(lengths), total, len(data)))
                out.write(numbers[block].tobytes() + nulls[block].tobytes() + lengths.tobytes())
                out.write(control)
                out.write(data)
                n_docs, n_values = n_docs + len(lengths), n_values + total
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "file": [name], "n_docs": [n_docs], "n_values": [n_values]}
            )

    files = max(1, -(-values // FILE_VALUES))
    ordered = encoded.repartitionByRange(files, F.col("doc_id").asc_nulls_first(), "crc").sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "crc"
    )
    return materialize(
        ordered.mapInArrow(run, "part long, file string, n_docs long, n_values long"), "token_manifest"
    )


def read_blocks(stream, ranked: np.ndarray) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """Document ids, lengths and ids (uint32) of each block of an open file."""
    while head := stream.read(struct.calcsize(HEAD)):
        mark, n, values, size = struct.unpack(HEAD, head)
        if mark != MARK:
            raise ValueError("not a block of token ids")
        numbers = np.frombuffer(stream.read(8 * n), "<i8").tolist()
        nulls = np.frombuffer(stream.read(n), np.uint8)
        lengths = np.frombuffer(stream.read(4 * n), "<u4").astype(np.int64)
        control = stream.read(-(-values // 4))
        found = ranked[unpack_values(control, stream.read(size), values)]
        yield [None if null else i for i, null in zip(numbers, nulls)], lengths, found


def read_files(manifest: DataFrame, folder: str, ranked: np.ndarray) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.select(
        "file", F.coalesce(F.sum("n_values").over(before), F.lit(0)).alias("base")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                with store.open_input_stream(f"{root}/{name}") as stream:
                    for doc_ids, lengths, found in read_blocks(stream, ranked):
                        ends = np.cumsum(lengths)
                        begins = ends - lengths
                        raw = memoryview(found.astype("<u4").tobytes())
                        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                        yield pa.RecordBatch.from_pydict(
                            {
                                "doc_id": pa.array(doc_ids, pa.int64()),
                                "start": pa.array(begins + start),
                                "n_tokens": pa.array(lengths),
                                "ids_crc32": pa.array(crc, pa.int64()),
                            }
                        )
                        start += int(ends[-1])

    files = max(1, min(manifest.count(), 10_000))
    return based.repartition(files, F.col("file")).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_files(spark: SparkSession, docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Encode all documents, write them to files in the shared folder and read those back."""
    own = tokenizer(path)
    encoded = materialize(encode_documents(docs, path, end_id), "token_ids")
    ranked = rank_table(encoded, own.vocabulary, own.kind)
    values = encoded.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    app = spark.sparkContext.applicationId
    folder = f"{scratch_folder(spark)}/tillroll/{app}/token-files-{uuid.uuid4().hex}"
    manifest = write_files(encoded, folder, ranked, own.kind, values // own.kind.itemsize)
    return read_files(manifest, folder, ranked)
