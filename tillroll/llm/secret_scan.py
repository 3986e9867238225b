"""Secrets in texts: patterns of known kinds, and random strings by token efficiency.

A tokenizer's vocabulary is made of what is frequent, so ordinary strings need few tokens
and random ones many. Runs of 20 or more characters as they occur in keys are cut into
tokens; a run with fewer characters per token than ``RATIO`` is random. Of a run that is not, the
parts between ``/``, ``=``, ``_`` and ``-`` of 20 or more characters are tested by themselves: a key
behind readable text. Before that, what is known to be harmless is cut out of the run: digests
(32, 40, 56, 64, 96 or 128 hexadecimal digits) and UUIDs; what remains on either side of them is
tested. Numbers (runs without a letter) are left out.

Positions count code points, the end is exclusive. A null text is the empty one, which has
no spans; texts are searched whole. Equal rows have equal results.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from .common import small_batches, texts

# The patterns of the base kinds and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_VALUE, LEAST_ACCESS = 12, 18

#: One of these stands in every text with a match of ``ASSIGN``, A-Z lower-cased.
_WORDS = (b"passw", b"secret", b"token", b"api")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
PART = re.compile(r"[A-Za-z0-9+]{20,}")
#: UUIDs and digests that no further letter or digit touches.
HARMLESS = re.compile(
    r"(?<![A-Za-z0-9])(?:[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}"
    r"|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})(?![A-Za-z0-9])",
    re.I,
)
#: Characters per token below which a run counts as random.
RATIO = 2.1
#: Order of the kinds at one start.
KINDS = ("assign", "access", "hex", "random")


@lru_cache(maxsize=1)
def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tiktoken.Encoding:
    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def characters_per_token(run: str) -> float:
    return len(run) / max(1, len(vocabulary().encode_ordinary(run)))


def is_random(run: str) -> bool:
    """Whether a run is a random string, by its characters per token; a number is none."""
    return any(map(str.isalpha, run)) and characters_per_token(run) < RATIO


def random_parts(run: str) -> Iterator[tuple[int, int]]:
    """``(start, end)`` of the random strings in a candidate run."""
    cuts = [m.span() for m in HARMLESS.finditer(run)]
    for begin, end in zip([0, *(b for _, b in cuts)], [*(a for a, _ in cuts), len(run)]):
        if cuts:
            begin += len(run[begin:end]) - len(run[begin:end].lstrip("/=_-"))
            end = begin + len(run[begin:end].rstrip("/=_-"))
        if end - begin < 20:
            continue
        if is_random(run[begin:end]):
            yield begin, end
        else:
            yield from (m.span() for m in PART.finditer(run, begin, end) if is_random(m[0]))


def base_spans(text: str, folded: bytes) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base kinds, in order."""
    found = []
    if any(w in folded for w in _WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if b"akia" in folded:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def random_spans(text: str) -> list[tuple[int, int, int]]:
    return [(m.start() + a, 3, m.start() + b) for m in CANDIDATE.finditer(text) for a, b in random_parts(m[0])]


def spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The spans of the base kinds, and all spans."""
    base = base_spans(text, text.encode("utf-8", "surrogatepass").lower())
    return base, sorted(base + random_spans(text))


def _joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def secret_spans(docs: DataFrame) -> DataFrame:
    """Per document row the counts and spans of its secrets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans(t) for t in batch.column("text").to_pylist()]
            counts = [[sum(s[1] == k for s in base) for base, _ in found] for k in range(3)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    **{f"n_{KINDS[k]}": pa.array(counts[k], pa.int64()) for k in range(3)},
                    "base_sha256": pa.array(
                        [hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found], pa.string()
                    ),
                    "spans": pa.array([_joined(all_) for _, all_ in found], pa.string()),
                }
            )

    return texts(docs).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redacted(text: str, mark: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones as one, replaced by the mark."""
    out, at = [], 0
    for start, _, end in spans(text)[1]:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def redact(docs: DataFrame) -> DataFrame:
    """The documents with their secrets replaced; a null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("text")
            clean = [None if t is None else redacted(t) for t in batch.column(place).to_pylist()]
            columns = batch.columns
            columns[place] = pa.array(clean, batch.schema.field(place).type)
            if "n_chars" in batch.schema.names:
                counted = batch.schema.get_field_index("n_chars")
                old = columns[counted].to_pylist()
                texts_before = batch.column(place).to_pylist()
                lengths = [n if a == b else len(b) for n, a, b in zip(old, texts_before, clean)]
                columns[counted] = pa.array(lengths, batch.schema.field(counted).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return small_batches(docs).mapInArrow(run, docs.schema)
