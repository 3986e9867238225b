"""Licence notices by a positional index of rare words.

Every template (a notice, or a bare licence name) has its words with their positions. Of the
words a text shares with the index, those with the highest inverse document frequency over
all documents are looked up first: the positions of a key phrase's words, each less its place
in the template, are intersected from the rarest word on, and what is left are places where
the phrase stands word by word. There the template's other rare words must stand at their
relative positions, give or take ``SLACK`` words, and all mandatory phrases are verified.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. A null text is the empty
one. Texts without a licence have empty labels, score 0 and no first or last place. The work
per text grows with its length; repeated rows have equal results.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import letter_words, texts

# Base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Label, notice, phrases that must stand in it word by word.
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("gpl-2.0", "gnu general public license version 2", ["general public license version 2"]),
    ("gpl-3.0", "gnu general public license version 3", ["general public license version 3"]),
    ("lgpl", "under the terms of the gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl", "under the terms of the gnu affero general public license", ["gnu affero general public license"]),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("epl", "made available under the terms of the eclipse public license", ["eclipse public license"]),
    ("bsl-1.0", "distributed under the boost software license version 1 0", ["boost software license"]),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        ["permission is hereby granted free of charge", "obtaining a copy of this software"],
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        ["redistribution and use in source and binary forms"],
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee",
        ["permission to use copy modify", "with or without fee"],
    ),
    ("cc-by-sa", "creative commons attribution sharealike", ["attribution sharealike"]),
    ("cc-by", "licensed under a creative commons attribution license", ["creative commons attribution"]),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", ["cc0 1 0"]),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ["free and unencumbered software"],
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors",
        ["provided as is without any express or implied warranty"],
    ),
]
#: Rare words of a template that are looked up, and the share that must be in place.
RARE, SHARE = 8, 0.7
#: Words that may be inserted or missing between a key phrase and another rare word.
SLACK = 3


@dataclass
class Template:
    label: str
    words: list[bytes]
    phrases: list[list[bytes]]
    base: bool
    needed: frozenset[bytes] = field(init=False)
    key: list[tuple[bytes, int]] = field(default_factory=list)
    rare: list[tuple[bytes, int]] = field(default_factory=list)

    def __post_init__(self):
        self.needed = frozenset(w for p in self.phrases for w in p)


def _find(words: list[bytes], phrase: list[bytes], begin: int, end: int) -> bool:
    n = len(phrase)
    return any(words[i : i + n] == phrase for i in range(max(0, begin), min(end, len(words)) - n + 1))


class Index:
    """The templates with the rarest words first, by document frequencies of the corpus."""

    def __init__(self, frequencies: dict[bytes, int], documents: int):
        idf = {w: math.log((documents + 1) / (frequencies.get(w, 0) + 1)) for w in vocabulary()}
        self.templates = templates()
        self.vocabulary = frozenset(idf)
        for t in self.templates:
            placed = sorted(((w, i) for i, w in enumerate(t.words)), key=lambda x: (-idf[x[0]], x[1]))
            t.rare = placed[:RARE]
            begin = next(i for i in range(len(t.words)) if t.words[i : i + len(t.phrases[0])] == t.phrases[0])
            t.key = [(w, i) for w, i in placed if begin <= i < begin + len(t.phrases[0])]

    def matches(self, words: list[bytes]) -> Iterator[tuple[Template, int, float]]:
        """Template, word where it begins, and share of its rare words in place."""
        present = self.vocabulary.intersection(words)
        live = [t for t in self.templates if t.needed <= present]
        if not live:
            return
        wanted = {w for t in live for w, _ in t.key + t.rare}
        positions: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            if w in wanted:
                positions.setdefault(w, []).append(i)
        sets = {w: set(p) for w, p in positions.items()}
        for t in live:
            (first, at), *others = t.key
            for i in positions.get(first, ()):
                place = i - at
                if any(place + p not in sets.get(w, ()) for w, p in others):
                    continue
                if t.base:
                    yield t, place, 1.0
                    continue
                found = sum(
                    any(place + p + d in sets.get(w, ()) for d in range(-SLACK, SLACK + 1)) for w, p in t.rare
                )
                share = found / len(t.rare)
                window = place - SLACK, place + len(t.words) + SLACK
                if share >= SHARE and all(_find(words, p, *window) for p in t.phrases):
                    yield t, place, share


def templates() -> list[Template]:
    base = [Template(label, p.encode().split(), [p.encode().split()], True) for p, label in BASE.items()]
    others = [
        Template(label, text.encode().split(), [p.encode().split() for p in phrases], False)
        for label, text, phrases in NOTICES
    ]
    return base + others


def vocabulary() -> frozenset[bytes]:
    return frozenset(w for t in templates() for w in t.words)


def licence_word_frequencies(docs: DataFrame) -> tuple[dict[bytes, int], int]:
    """In how many documents each word of the index occurs, and the number of documents.

    The driver gets one number per word of the index.
    """
    known = vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                seen.update(known.intersection(letter_words(text)))
            seen[b""] += batch.num_rows
        yield pa.RecordBatch.from_pydict(
            {"word": [w.decode() for w in seen], "n": pa.array(list(seen.values()), pa.int64())}
        )

    counted = texts(docs).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {row["word"].encode(): row["n"] for row in counted.collect()}
    return found, found.pop(b"", 0)


def licenses(docs: DataFrame) -> DataFrame:
    """Licence labels and places of the base phrases for every document row."""
    frequencies, documents = licence_word_frequencies(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(frequencies, documents)
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("words", "base", "first", "last", "blabels", "labels", "score")}
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = letter_words(text)
                found = list(index.matches(words))
                places = [place for t, place, _ in found if t.base]
                out["words"].append(len(words))
                out["base"].append(len(places))
                out["first"].append(min(places, default=None))
                out["last"].append(max(places, default=None))
                out["blabels"].append(",".join(sorted({t.label for t, _, _ in found if t.base})))
                out["labels"].append(",".join(sorted({t.label for t, _, _ in found})))
                out["score"].append(max((share for _, _, share in found), default=0.0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(out[k], pa.int64()) for k in ("words", "base", "first", "last")),
                    *(pa.array(out[k], pa.string()) for k in ("blabels", "labels")),
                    pa.array(out["score"], pa.float64()),
                ],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return texts(docs).mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double",
    )
