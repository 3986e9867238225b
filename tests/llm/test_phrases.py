"""Collocations against plain counting."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, f long, trie long, rank long, a long"


def plain(rows, least, covered, top):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    found = []
    for lang, by in counts.items():
        wanted = {p: a for p, a in by.items() if len(p) > 1 and a >= least}
        inside = {q for p, a in wanted.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= covered * by[q]}
        scored = []
        for p, a in wanted.items():
            if p not in inside:
                score, k = min((10**6 * a * a // (by[p[:k]] * by[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), by[p[:k]], by[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return Counter(found)


def texts(rng, n):
    words = ["the", "of", "New", "York", "a\x1cb", "é", "日本", "x", "\x00", "İ"] + [f"w{i}" for i in range(30)]
    share = 1 / np.arange(1, len(words) + 1)
    for _ in range(n):
        chosen = rng.choice(words, rng.integers(0, 60), p=share / share.sum())
        yield "".join(w + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0b"], p=[0.8, *[0.2 / 6] * 6]) for w in chosen)


@pytest.mark.parametrize("least, covered, top", [(10, 50, 2000), (3, 50, 20), (1, 100, 5)])
def test_against_plain_counting(spark, least, covered, top):
    rng = np.random.default_rng(least)
    rows = [(["en", "fr", "und", None][i % 4], t) for i, t in enumerate(texts(rng, 400))]
    rows += [("en", None), ("xx", ""), (None, None), ("en", "new york " * 5000), ("en", "same same same")]
    rows += [("hot", "copy of a copy of a copy")] * 300
    frame = spark.createDataFrame([(1, t, lang, "p", 1, 2, 3, 4) for lang, t in rows], SCHEMA)
    found = Counter(map(tuple, phrases.collocations(frame, least, covered, top).collect()))
    assert found == plain(rows, least, covered, top)


def test_empty_table_and_two_words(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert phrases.collocations(frame).count() == 0
    frame = spark.createDataFrame([(1, "a b c " * 9, "en", "p", 1, 2, 3, 4)], SCHEMA)
    assert {len(r["phrase"].split()) for r in phrases.collocations(frame, 2, longest=2).collect()} == {2}
    with pytest.raises(ValueError):
        phrases.collocations(frame, longest=4)


def test_small_tries_chunks_and_memory_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [("en", t) for t in texts(rng, 300)]
    frame = spark.createDataFrame([(1, t, lang, "p", 1, 2, 3, 4) for lang, t in rows], SCHEMA)
    plainly = phrases.small_batches(phrases.by_language(frame))
    words = phrases.word_counts(plainly)
    wanted = phrases.candidates(plainly, words.where("f >= 3"), 2, 3)
    one = Counter(map(tuple, phrases.phrase_counts(plainly, wanted).collect()))
    many = Counter(map(tuple, phrases.phrase_counts(plainly, wanted, 25).collect()))
    assert one == many and len(one) > 100


@pytest.mark.parametrize("words, phrases_of", [(5, 12), (400, 3000), (3000, 2000)])
def test_double_array(words, phrases_of):
    rng = np.random.default_rng(words)
    made = {tuple(rng.integers(0, words, rng.integers(1, 4)).tolist()) for _ in range(phrases_of)}
    made |= {(0, i) for i in range(words)}  # one node has every child
    made = sorted(made)
    lengths = np.array([len(p) for p in made])
    paths = np.zeros((len(made), 3), np.int64)
    for row, p in zip(paths, made):
        row[: len(p)] = p
    base, check, accept = phrases.double_array(paths, lengths, words)
    state = np.zeros(len(made), np.int64)
    for level in range(3):
        active = lengths > level
        following = base[state[active]] + paths[active, level]
        assert (check[following] == state[active]).all()
        state[active] = following
    assert (accept[state] == np.arange(len(made))).all()
    assert (accept >= 0).sum() == len(made)
    assert len(base) < 40 * (len(made) + words)


def test_texts_are_cut_at_ends_of_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 10)
    text = b"one two. three four five six seven. eight."
    assert b".".join(phrases._parts(text)) == text
    assert list(phrases._parts(b"no end of a piece anywhere here")) == [b"no end of a piece anywhere here"]


def test_candidates_are_handed_on_packed(spark):
    """Few rows go through Spark, whatever the number of phrases."""
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(60)]
    rows = [(["en", "fr"][i % 2], " ".join(rng.choice(words, 400))) for i in range(60)]
    frame = spark.createDataFrame([(1, t, lang, "p", 1, 2, 3, 4) for lang, t in rows], SCHEMA).coalesce(2)
    plainly = phrases.small_batches(phrases.by_language(frame))
    frequent = phrases.word_counts(plainly).where("f >= 3")
    counts = Counter((lang, *p) for lang, t in rows for p in zip(t.split(), t.split()[1:]))
    expected = Counter((lang, f"{a} {b}") for (lang, a, b), n in counts.items() if n >= 3)
    for buckets in (1, 7, 300):
        found = phrases.candidates(plainly, frequent, 2, 3, buckets)
        assert Counter(map(tuple, found.collect())) == expected
    # every task packs its phrases, more than 3,000 of a language, into a row per bucket
    known = phrases.Words()
    codes = known.codes([b"a", b"b", b"c d"])
    keys = np.array([codes[0] << 21 | codes[1], codes[1] << 21 | codes[2], codes[2] << 21 | codes[0]])
    sent = [r for b in phrases._packed(b"en", known, keys, np.array([1, 2, 3]), 2, 2) for r in b.to_pylist()]
    assert len(sent) <= 2 and sorted(b"".join(r["phrases"] for r in sent).split(b"\n")) == [b"", b"a b", b"b c d", b"c d a"]


def test_packed_phrases_are_not_made_one_by_one(monkeypatch):
    class Column:
        def __init__(self, own):
            self.buffers, self.offset = own.buffers, own.offset

    join = phrases.pc.binary_join_element_wise
    monkeypatch.setattr(phrases.pc, "binary_join_element_wise", lambda *columns: Column(join(*columns)))
    words = phrases.Words()
    a, b = words.codes([b"a", b"bc"]).tolist()
    keys = np.array([x << phrases._SHIFT | y for x, y in ((a, b), (b, a), (b, b))])
    for buckets in (1, 7):
        rows = list(phrases._packed(b"en", words, keys, np.array([3, 4, 5]), 2, buckets))
        packed = [p for row in rows for p in row.column("phrases").to_pylist()]
        assert sorted(b"".join(packed).split(b"\n")) == [b"", b"a bc", b"bc a", b"bc bc"]


def test_words_are_cut_and_looked_up_in_arrow():
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "en", "fr"], "text": ["  A b\x1c.b\t\tÉ\n", "", ". x,"]})
    found = {lang: words.to_pylist() for lang, words in phrases.token_lists(batch)}
    assert found == {b"en": [b"a", b"b\x1c", b".", b"b", "É".encode(), b".", b"."], b"fr": [b".", b"x", b"."]}
    words = pa.array([b"b", b"a", b"b", b"."], pa.binary())
    assert phrases._looked_up({b"a": 5, b"b": 7, b".": -1}.__getitem__, words).tolist() == [7, 5, 7, -1]


def test_only_words_of_kept_phrases_get_codes(spark, monkeypatch):
    class Bounded(phrases.Words):
        def __missing__(self, word):
            assert not word.startswith(b"rare"), "a word of no candidate is kept"
            return super().__missing__(word)

    monkeypatch.setattr(phrases, "Words", Bounded)
    rows = [("en", f"new york rare{i} old york rarely{i}") for i in range(40)]
    frame = spark.createDataFrame([(1, t, lang, "p", 1, 2, 3, 4) for lang, t in rows], SCHEMA).coalesce(2)
    plainly = phrases.small_batches(phrases.by_language(frame))
    bits = phrases.phrase_filter(phrases.word_counts(plainly).where("f >= 10"))
    monkeypatch.setattr(phrases, "phrase_filter", lambda _: bits)
    runs = []

    class Plain:
        sparkSession = spark

        def mapInArrow(self, run, _):
            runs.append(run)
            return self

        def repartition(self, *_):
            return self

    phrases.candidates(Plain(), None, 2, 10)
    sent = [r for b in runs[0](iter(plainly.toArrow().to_batches())) for r in b.to_pylist()]
    assert sorted(b"".join(r["phrases"] for r in sent).split()) == [b"new", b"old", b"york", b"york"]


def test_packing_phrases_keeps_no_memory():
    words = phrases.Words()
    codes = words.codes([b"word%d" % i for i in range(2000)])
    keys = codes[:-1] << phrases._SHIFT | codes[1:]

    def held():
        for batch in phrases._packed(b"en", words, keys, np.ones(len(keys), np.int64), 2, 5):
            assert batch.num_rows
        del batch
        return pa.total_allocated_bytes()

    held()
    first = held()
    assert all(held() <= first for _ in range(3))
