"""SentencePiece encoding by a table of last pieces per prefix, and decoding.

The merge rules (best score first, leftmost among equals) give every prefix of a word one
encoding, and that encoding minus its last piece is the encoding of a shorter prefix. So it
is enough to keep, for each prefix, its last piece: of the pieces that an automaton finds
to end there, the one that follows the last piece of the remaining prefix without a merge
across their border. Ids are recovered from the end backwards.

Whether two pieces can stand side by side is tested on the two alone and remembered, also for the
next partitions: it is a matter of the model and not of the texts.

No piece spans a word border (a space after something else) or a character that occurs in
no piece, so texts are cut there and the result of a word is cached. The cut and the
absence of other normalisation are checked against the model when it is loaded.

A null text is the empty one, which has no ids. Texts of any length and content are encoded
whole; characters without a piece become the pieces of their UTF-8 bytes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import Memo, small_batches, texts

#: SentencePiece's sign for a space.
SPACE = "▁"
#: Words longer than this are encoded but not cached.
LONGEST_CACHED = 64
#: Pairs of pieces remembered at once, and at most from one partition to the next.
PAIRS, KEPT_PAIRS = 500_000, 200_000


class PrefixEncoder:
    """Encoder for one BPE model file with byte fallback."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib = self.library
        plain = [
            i
            for i in range(lib.get_piece_size())
            if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))
        ]
        self._ids = {lib.id_to_piece(i): i for i in plain}
        self._scores = {p: lib.get_score(i) for p, i in self._ids.items()}
        self._bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self._check_model()
        self._side_by_side: dict[int, bool] = {}
        self._plain = {i: p for p, i in self._ids.items()}
        self._size = lib.get_piece_size()
        self._decimal = [b",%d" % i for i in range(self._size)]
        self._automaton = ahocorasick.Automaton()
        for piece, number in self._ids.items():
            if self.merged(piece) == [piece]:
                self._automaton.add_word(piece, (len(piece), number))
        self._automaton.make_automaton()
        self._known = frozenset(chain.from_iterable(self._ids))
        if not self._known <= self._ids.keys():
            raise ValueError("a character of a longer piece is no piece itself")
        cuts = "" if "\n" in self._known else "\n"
        self._words = re.compile(
            f"{SPACE}+[^{SPACE}{cuts}]*|[^{SPACE}{cuts}]+" + "|\n" * bool(cuts)
        )
        self._cache = Memo(self._cached)

    def _check_model(self) -> None:
        if any(SPACE in p.lstrip(SPACE) for p in self._ids):
            raise ValueError("a piece spans a word border; this model can't be cut into words")
        sample = "Éﬁ ½　é  \tX "
        if self.library.normalize(sample) != SPACE + sample.replace(" ", SPACE):
            raise ValueError("the model normalises texts; only identity with a first space is built")
        if not all(self.library.is_byte(i) for i in self._bytes):
            raise ValueError("the model has no byte fallback")

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by the merge rules themselves."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self._scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether two pieces next to each other stay as they are."""
        if len(self._side_by_side) > PAIRS:
            self._side_by_side.clear()
        pair = [self._plain[left], self._plain[right]]
        answer = self._side_by_side[left * self._size + right] = self.merged("".join(pair)) == pair
        return answer

    def _known_ids(self, word: str) -> list[int]:
        """Ids of a word of known characters: fills the prefix table, then walks it back."""
        last = [-1] * (len(word) + 1)
        starts = last[:]
        remembered, size = self._side_by_side.get, self._size
        for end, (length, piece) in self._automaton.iter(word):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length
            if start:
                left = last[start]
                fits = remembered(left * size + piece)
                if fits is None:
                    fits = self.compatible(left, piece)
                if not fits:
                    continue
            last[end], starts[end] = piece, start
        found, end = [], len(word)
        while end:
            found.append(last[end])
            end = starts[end]
        found.reverse()
        return found

    def word_ids(self, word: str) -> list[int]:
        if self._known.issuperset(word):
            return self._known_ids(word)
        found, begin = [], 0
        for i, character in enumerate(word):
            if character not in self._known:
                found += self._known_ids(word[begin:i])
                found += [self._bytes[b] for b in character.encode()]
                begin = i + 1
        return found + self._known_ids(word[begin:])

    def _cached(self, word: str) -> tuple[bytes, tuple[int, ...]]:
        found = self.word_ids(word)
        return b"".join([self._decimal[i] for i in found]), tuple(found)

    def encode(self, text: str) -> tuple[bytes, list[int]]:
        """The ids as decimal numbers joined by commas, and as a list."""
        if not text:
            return b"", []
        words = self._words.findall(SPACE + text.replace(" ", SPACE))
        cache = self._cache
        found = [cache[w] if len(w) <= LONGEST_CACHED else self._cached(w) for w in words]
        return b"".join([f[0] for f in found])[1:], list(chain.from_iterable([f[1] for f in found]))

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids)

    def forget(self) -> None:
        """Drop what was remembered of words, and of pairs if they are very many."""
        self._cache.forget()
        if len(self._side_by_side) > KEPT_PAIRS:
            self._side_by_side.clear()


@lru_cache(maxsize=1)
def encoder(path: str) -> PrefixEncoder:
    return PrefixEncoder(path)


def encode_pieces(docs: DataFrame, model: str, with_ids: bool = False) -> DataFrame:
    """Per document row the number and digests of its ids and of the decoded text.

    ``with_ids`` adds the ids themselves and the decoded text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for batch in batches:
            encoded = [own.encode(t) for t in batch.column("text").to_pylist()]
            decoded = own.decode([ids for _, ids in encoded]) if encoded else []
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array([len(ids) for _, ids in encoded], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(joined).hexdigest() for joined, _ in encoded], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string()),
            }
            if with_ids:
                columns["ids"] = pa.array([ids for _, ids in encoded], pa.list_(pa.int32()))
                columns["decoded"] = pa.array(decoded, pa.string())
            yield pa.RecordBatch.from_pydict(columns)
        own.forget()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return small_batches(texts(docs)).mapInArrow(run, schema + ", ids array<int>, decoded string" * with_ids)
