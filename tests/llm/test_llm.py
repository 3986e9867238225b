"""Each operator against a plain version of itself, and on awkward rows."""

import hashlib
import math
import os
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

ROOT = str(Path(__file__).resolve().parents[2])
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
sys.path.insert(0, ROOT)

import corpus_pipeline  # noqa: E402
from tillroll.llm import (  # noqa: E402
    common, components, decontamination, language_model, licenses, pieces, queries, secret_scan, simhash,
    token_files, toxicity, vectors, warc,
)

DATA = "/root/testdata/sf0.001"
LONG = "thanedble ofer " * 4000
ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
AWKWARD = [
    (1, "the mit license and the Apache License. " + ITEM, "en", "a", 3),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (None, "no id here, token = abcdefghijklmn0123", None, "b", 1),
    (5, LONG, "en", "a", 9),
    (6, "same text twice", "en", "a", 1),
    (6, "same text twice", "en", "a", 1),
    (7, "same text twice", "en", "a", 1),
    (6, "another text of one id", "en", "a", 1),
    (8, "\n \t é　x\r\n;\r 日本語 \x00 ▁▁ <s>", "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def rows_of(frame):
    return [(r["doc_id"], r["text"] or "") for r in frame.select("doc_id", "text").collect()]


def same(frame, expected):
    assert Counter(map(tuple, frame.collect())) == Counter(expected)


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text)) if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("name", ["docs", "documents", "empty"])
def test_simhash(request, name):
    frame = request.getfixturevalue(name)
    rows = [(i, plain_fingerprint(t)) for i, t in rows_of(frame)]
    root = list(range(len(rows)))
    for _ in rows:
        before = root[:]
        for a in range(len(rows)):
            for b in range(len(rows)):
                if (rows[a][1] ^ rows[b][1]).bit_count() <= 2:
                    root[a] = min(root[a], root[b])
        if before == root:
            break
    least = {r: min((rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None), default=None) for r in root}
    same(simhash.simhash_duplicates(frame), [(i, f"{f:016x}", least[root[k]]) for k, (i, f) in enumerate(rows)])


def test_near_fingerprints_and_chains(spark):
    base = 0x0123456789ABCDEF
    prints = spark.createDataFrame(
        [(9, 0, base), (8, 0, base ^ 3), (7, 0, base ^ 15), (6, 0, base ^ 0xFF00), (5, 0, -1)],
        "doc_id long, text_key long, fp long",
    )
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(prints).collect()}
    assert found == {9: 7, 8: 7, 7: 7, 6: 6, 5: 5}


def test_components_of_a_long_path(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["root"] for r in components.components(edges).collect()} == {0}


def test_keep_one_keeps_the_smallest_id(docs):
    kept = rows_of(simhash.keep_one(docs))
    assert kept.count((6, "same text twice")) == 1 and (7, "same text twice") not in kept
    assert (6, "another text of one id") in kept and len(kept) == 7


def plain_kept(rows):
    """Rows that keep_one leaves of rows with distinct ids."""
    prints = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                one, two = sorted((top(a), top(b)), key=lambda i: rows[i][0])
                root[two] = one
    return [row for i, row in enumerate(rows) if top(i) == i]


def test_keep_one_against_plain_fingerprints(spark):
    rng = np.random.default_rng(8)
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    base = [f"v{i}" for i in range(3000)]
    for k in range(60):
        at = rng.integers(0, 3000, k % 4)
        rows.append((9_000_000 + k, " ".join(f"x{k}" if i in at else w for i, w in enumerate(base))))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    expected = plain_kept([(i, t or "") for i, t in rows])
    assert Counter(rows_of(simhash.keep_one(frame))) == Counter(expected)
    assert len(expected) < len(rows)


INTERNAL = (
    "text_key text_key_ kept_id kept_key root fp first unnamed component_id toxicity_score score"
    " hit_id hit_key item_id variant spans"
).split()


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_with_clashing_columns(spark, name):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    wide = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in INTERNAL})
    stage = dict(corpus_pipeline.STAGES)[name]
    plain = stage(spark, docs, DATA).collect()
    found = stage(spark, wide, DATA)
    assert found.columns == wide.columns
    rows = found.collect()
    assert all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in INTERNAL)
    assert Counter(tuple(r[c] for c in docs.columns) for r in rows) == Counter(map(tuple, plain))


@pytest.mark.parametrize("name", ["docs", "documents", "empty"])
def test_pieces(request, name):
    frame = request.getfixturevalue(name)
    library = pieces.encoder(queries.PIECE_MODEL).library
    expected = []
    for i, text in rows_of(frame):
        ids = library.encode(text)
        told = [hashlib.sha256(s.encode()).hexdigest() for s in (",".join(map(str, ids)), library.decode(ids))]
        expected.append((i, len(ids), *told))
    same(pieces.encode_pieces(frame, queries.PIECE_MODEL), expected)


@pytest.mark.parametrize("name", ["docs", "documents", "empty"])
def test_token_files(spark, request, name):
    frame = request.getfixturevalue(name)
    library = Tokenizer.from_file(queries.WORD_TOKENIZER)
    encoded = []
    for i, text in rows_of(frame):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4").tobytes()
        narrow = np.frombuffer(ids, "<u4").astype("<u2").tobytes()
        encoded.append((i is not None, i or 0, zlib.crc32(narrow), i, ids))
    start, expected = 0, []
    for *_, i, ids in sorted(encoded):
        expected.append((i, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    same(token_files.token_files(spark, frame, queries.WORD_TOKENIZER), expected)


def test_tokens_around_separators_that_are_no_white_space():
    own = token_files.tokenizer(queries.WORD_TOKENIZER)
    for c in map(chr, [*range(1, 33), 0x7F, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]):
        for text in (f"ab{c}cd", f"ab {c} cd", f"{c}ab cd{c}"):
            expected = own.library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(own.encode(text), own.kind).tolist() == expected, text


def test_texts_of_many_signs_equal_the_library():
    library = Tokenizer.from_file(queries.WORD_TOKENIZER)
    rng = np.random.default_rng(9)
    letters = [chr(c) for c in range(32, 0x250)] + list("ΣσςАБвг日本語ع\u0301\u0308İıßſﬁ½²٣'’\u00a0\u2003\u200b😀👍🏽\x00\x1d,.!?-_") + [" "] * 60
    texts = ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(3000)] + ["Plain words, capitals. And STOPS..,", "", "word " * 9000]
    found = list(map(token_files.WordTokenizer(queries.WORD_TOKENIZER).encode, texts))
    expected = [np.array(library.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert found == expected


def test_token_files_remember_pieces_and_forget_them():
    own = token_files.WordTokenizer(queries.WORD_TOKENIZER)
    texts = ["House house, HOUSE! (house) house's", "Ünder ſ ÀÇ Ÿ Ɖ ²³ 4711 a\x01b c\xa0d\x85e 'Tis Σας ǅ", "拾ꍀ 一二 ½3x"]
    for text in texts:
        expected = own.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), own.kind).tolist() == expected
    assert sum("house" in piece.lower() for piece in [*own._pieces, *own._words]) == 1
    own.forget()
    assert not own._pieces and not own._words


def test_values_of_all_sizes_survive_packing():
    for n in (0, 1, 3, 4, 1001):
        values = np.random.default_rng(n).integers(0, 2 ** np.arange(1, n + 1).clip(1, 32), n, dtype=np.uint64)
        packed = token_files.pack_values(values)
        assert (token_files.unpack_values(*packed, n) == values).all()


@pytest.mark.parametrize("name", ["docs", "documents", "empty"])
def test_base_secrets(request, name):
    frame = request.getfixturevalue(name)
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    expected = []
    for i, text in rows_of(frame):
        found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        told = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))
        expected.append((i, *(sum(k == j for _, k, _ in found) for j in range(3)), hashlib.sha256(told.encode()).hexdigest()))
    same(secret_scan.secret_spans(frame).drop("spans"), expected)


def test_random_strings_and_redaction(spark):
    key = "Zq8vR2mX9kLw3TbN7yHc"
    text = f"é {key} and d41d8cd98f00b204e9800998ecf8427e, 123e4567-e89b-12d3-a456-426614174000 thanedbleofthandert"
    found = secret_scan.random_spans(text)
    assert [text[a:b] for a, _, b in found] == [key]
    frame = spark.createDataFrame([(1, f"x {key} y", 30), (2, None, 4), (3, "clean", 5)], "doc_id long, text string, n_chars long")
    same(secret_scan.redact(frame), [(1, "x [SECRET] y", 12), (2, None, 4), (3, "clean", 5)])


def test_random_keys_of_several_kinds_and_prefixes():
    rng = np.random.default_rng(12)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    uuid, digest = "123e4567-e89b-12d3-a456-426614174000", "d41d8cd98f00b204e9800998ecf8427e"
    prefixes = ("", "/internal/services/webhooks/production/", "customer_account_access_", f"{uuid}/", f"{uuid}-", f"{digest}=", f"{digest}_")
    for signs in (letters + "0123456789", letters):
        for length in (20, 24, 32, 48):
            for prefix in prefixes:
                for _ in range(20):
                    key = "".join(rng.choice(list(signs), length))
                    found = secret_scan.random_spans(f"x {prefix}{key} y")
                    assert any(a <= 2 + len(prefix) and b >= 2 + len(prefix) + length for a, _, b in found), prefix + key
    harmless = f"{uuid} {digest} {uuid}/{digest} images/{digest} 12345678901234567890 2024-01-02/2024-01-03 /internal/services/webhooks/production"
    assert not secret_scan.random_spans(harmless)
    assert not secret_scan.random_spans("getInternalServiceConfiguration Donaudampfschifffahrtsgesellschaft --------------------")


@pytest.mark.parametrize("name", ["docs", "documents", "empty"])
def test_base_licenses(request, name):
    frame = request.getfixturevalue(name)
    phrases = {tuple(p.split()): label for p, label in licenses.BASE.items()}
    expected = []
    for i, text in rows_of(frame):
        folded = text.translate({c: c + 32 for c in range(65, 91)})
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
        at = [(k, label) for k in range(len(words)) for p, label in phrases.items() if tuple(words[k : k + len(p)]) == p]
        places = [k for k, _ in at]
        expected.append((i, len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))))
    found = licenses.licenses(frame)
    same(found.drop("labels", "score"), expected)
    assert found.where("score < 0 OR score > 1").count() == 0


def test_notice_with_inserted_words(spark):
    text = "Permission is hereby granted, free of charge, to any (lucky) person obtaining a copy of this software"
    frame = spark.createDataFrame([(1, text), (2, "permission granted of free charge")], "doc_id long, text string")
    assert {r["doc_id"]: r["labels"] for r in licenses.licenses(frame).collect()} == {1: "mit", 2: ""}


def test_language_model_cuts_words_in_arrow_and_trains_alike_with_small_logits(monkeypatch):
    texts_of = ["  A b\x1c\x0bÉ ", "", "x", "\x85a\u3000B\t"]
    found, ends = language_model._words(pa.RecordBatch.from_pydict({"text": texts_of}))
    words = [common.space_words(t.encode()) for t in texts_of]
    assert found.to_pylist() == sum(words, []) and ends.tolist() == np.cumsum([len(w) for w in words]).tolist()
    rng = np.random.default_rng(4)
    n = 6000
    v = language_model.Vocabulary([b"", *(b"w%d" % i for i in range(1, n))], [3 * n - i for i in range(n)], 3 * n * n, n)
    documents = [np.append(rng.integers(1, n + 1, 60), 0).astype(np.int32) for _ in range(90)]
    trained = []
    for small in (60, 0):
        monkeypatch.setattr(language_model, "SMALL_LOGITS", small)
        trainer = language_model.Trainer(v, language_model.Network(v), 1e-3)
        assert trainer.net.small_logits() == bool(small)
        trainer.learn(documents)
        trained.append(language_model.score_documents(v, trainer.net, documents))
    assert np.allclose(*trained, rtol=1e-5)


def test_language_model(spark, docs, documents, empty):
    for frame in (docs, documents, empty):
        rows = rows_of(frame)
        kept = [t for i, t in rows if zlib.crc32(str(i if i is not None else "").encode()) % 7 != 2]
        counts = Counter(w for t in kept for w in [*t.encode().lower().split(), b""])
        total, kinds = sum(counts.values()), len(counts)
        expected = Counter()
        for i, text in rows:
            words = [*text.encode().lower().split(), b""]
            base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words)
            out = zlib.crc32(str(i if i is not None else "").encode()) % 7 == 2
            expected[i, out, len(words), sum(counts[w] > 0 for w in words), total, round(base, 6)] += 1
        found = language_model.scored_texts(spark, frame).collect()
        assert Counter((*r[:5], round(r[5], 6)) for r in found) == expected
        assert all(r["score"] < 0 for r in found)


def test_head_words_without_a_cut_through_equal_counts(spark):
    rows = [(f"w{i}".encode(), 1 + i // 4) for i in range(400)] + [(b"", 90_000), (b"the", 100_000)]
    counts = spark.createDataFrame(rows, "word binary, n long")
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    for most in (1, 2, 5, 6, 9, 100, 1000):
        found = [(bytes(r["word"]), r["n"]) for r in language_model.head_words(counts, most)]
        assert found == order[: len(found)] and most - 4 < len(found) <= most or found == order
    assert language_model.head_words(counts.limit(0)) == []


def test_model_probabilities_add_up():
    words = [b"", *(b"w%d" % i for i in range(1500))]
    v = language_model.Vocabulary(words, [1600 - i for i in range(1501)], 10**7, 2000)
    net = language_model.Network(v)
    n = len(words)
    first = language_model.score_documents(v, net, [np.array([r]) for r in range(n + 1)])
    assert abs((10**first).sum() - 1) < 1e-4
    long = np.random.default_rng(1).integers(0, n, 100)
    alone = language_model.score_documents(v, net, [long])[0]
    assert abs(language_model.score_documents(v, net, [long, long[:7], long[:40]])[0] - alone) < 1e-3


def test_words_beyond_the_most_frequent_are_scored_by_context():
    n, rng = 1500, np.random.default_rng(2)
    v = language_model.Vocabulary([b"", *(b"w%d" % i for i in range(n))], [10**6, *([50] * n)], 10**6 + 50 * n, n + 1)
    rare = v.soft + np.arange(64)  # two words after w0 and two others after w1, in the same leaves
    pairs = [([1, rare[3]], [1, rare[40]]), ([2, rare[9]], [2, rare[50]])]
    documents = [np.array([*pairs[k][j], v.end], np.int32) for k, j in rng.integers(0, 2, (6000, 2)).tolist()]
    net = language_model.Network(v)
    before = language_model.score_documents(v, net, [np.array([1, rare[3]]), np.array([1, rare[9]])])
    trainer = language_model.Trainer(v, net, 2e-2)
    for i in range(0, 6000, 500):
        trainer.learn(documents[i : i + 500])
    score = lambda a, b: language_model.score_documents(v, net, [np.array([a, b])])[0]
    assert abs(before[0] - before[1]) < 1e-3
    assert score(1, rare[3]) > score(1, rare[9]) + 0.4 and score(2, rare[9]) > score(2, rare[3]) + 0.4
    assert abs(sum(10 ** language_model.score_documents(v, net, [np.array([r]) for r in range(n + 2)])) - 1) < 1e-4


def test_models_are_averaged_by_tokens_in_a_tree(spark):
    rows = [(k % 3, f"w{k % 7} w{k % 11} x{k}") for k in range(600)]
    for parts in (1, 3, 130):
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        found = language_model.language_scores(spark, frame, F.lit(True)).collect()
        assert len(found) == 600 and all(-30 < r["score"] < 0 for r in found)


def test_toxicity(spark, documents, empty, docs):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    none = labels.limit(0)
    assert toxicity.toxicity(empty, none).count() == 0
    same(toxicity.toxicity(docs, none).select("doc_id", "score", "predicted"), [(r[0], 0.0, 0) for r in AWKWARD])
    assert toxicity.drop_toxic(docs, none).columns == docs.columns


def test_string_kernel_against_plain_sum():
    def plain(unit):
        out = Counter()
        for i in range(len(unit)):
            for j in range(i + 1, len(unit)):
                for k in range(j + 1, min(len(unit), i + toxicity.STRETCH)):
                    if " " not in unit[i] + unit[j] + unit[k]:
                        out[unit[i], unit[j], unit[k]] += toxicity.DECAY ** (k - i + 1)
        return out

    def cosine(a, b):
        size = lambda c: math.sqrt(sum(v * v for v in c.values()))
        return sum(v * b[u] for u, v in a.items()) / (size(a) * size(b))

    names = ["idiot", "banana", "stupid"]
    asked = ["idiot", "i d i o t", "ixdiot", "bananas", "stu pid", "other"]
    found = toxicity.kernel(asked, toxicity.landmark_vectors(names))
    for i, a in enumerate(asked):
        for j, b in enumerate(names):
            value = math.exp(-2 * toxicity.SHARPNESS * (1 - cosine(plain(a), plain(b))))
            assert abs(found[i, j] - (value if value >= toxicity.LEAST_VALUE else 0)) < 1e-3


def test_units_away_from_all_landmarks_are_not_measured(monkeypatch):
    """Bounds by groups of landmarks leave out units that one bound for all of them would let through."""
    rng = np.random.default_rng(3)
    word = lambda n: "".join(map(chr, rng.integers(97, 105, n)))
    names = sorted({word(6) for _ in range(120)})[:96]
    asked = sorted({word(rng.integers(5, 12)) for _ in range(600)}) + names[:5] + [f"{n}x" for n in names[5:9]]
    vectors = toxicity.landmark_vectors(names)
    measured, norms = [], toxicity._norms
    monkeypatch.setattr(toxicity, "_norms", lambda c, w, t: (measured.append(len(c)), norms(c, w, t))[1])
    found = toxicity.kernel(asked, vectors)
    grouped, measured[:] = sum(measured), []
    monkeypatch.setattr(toxicity, "_grouped", lambda dense: dense.max(axis=1)[None])
    assert (found == toxicity.kernel(asked, vectors)).all() and found.any()
    assert grouped < 0.7 * sum(measured)
    for unit in ("it's", "A1b", "-x-", "i", "ÉTÉ!", "\x00a\x7f", "I.D"):
        cut = "".join(c for c in toxicity.unicodedata.normalize("NFKD", unit) if not toxicity.unicodedata.combining(c))
        plain = "".join(c if "a" <= c <= "z" else "{" if c.isalpha() else " " for c in cut.lower()).strip()
        assert toxicity.plain_letters(unit) == plain


def test_toxicity_of_unseen_documents():
    read = lambda t: f"'/root/testdata/sf0.01/{t}.parquet'"
    rows = duckdb.sql(
        f"SELECT doc_id, coalesce(text, ''), toxic FROM {read('documents')} JOIN {read('labels')} USING (doc_id) ORDER BY 1"
    ).fetchall()
    learnt = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    rest = [r for r in rows if not zlib.crc32(str(r[0]).encode()) % 5]
    machine = toxicity.fit([r[1] for r in learnt], [r[2] for r in learnt])
    right = [(s >= 0.5) == bool(r[2]) for s, r in zip(machine.scores([r[1] for r in rest]), rest)]
    assert np.mean(right) > 0.85


def test_decontamination(spark, docs, empty):
    items = spark.createDataFrame(
        [(10, ITEM), (10, ITEM), (11, "same text twice"), (12, None), (13, ""), (None, ITEM + " fifteen"), (14, "a b c d e f")],
        "item_id long, text string",
    )
    found = Counter(map(tuple, decontamination.contaminated(docs, items).collect()))
    assert found == Counter({(1, 10, 10, 10, 1.0): 1, (6, 11, 1, 1, 1.0): 1, (7, 11, 1, 1, 1.0): 1, (1, None, 11, 10, 10 / 11): 1})
    assert decontamination.contaminated(empty, items).count() == 0
    assert decontamination.contaminated(docs, items.limit(0)).count() == 0
    assert sorted(i or 0 for i, _ in rows_of(decontamination.drop_contaminated(docs, items))) == [0, 2, 3, 5, 6, 8]


def test_short_passage_in_a_long_document(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in rng.integers(0, 5000, 20_000)]
    passage = " ".join(f"p{i}" for i in range(40))
    text = " ".join([*words[:7777], passage, *words[7777:]])
    found = decontamination.contaminated(
        spark.createDataFrame([(1, text)], "doc_id long, text string"),
        spark.createDataFrame([(1, passage)], "item_id long, text string"),
    )
    same(found.select("item_id", "containment"), [(1, 1.0)])


def test_short_items_anywhere_in_long_documents(spark):
    rng = np.random.default_rng(6)
    docs, items = [], []
    for n in range(5, 13):
        for k in range(60):
            words = [f"w{i}" for i in rng.integers(0, 5000, 400)]
            item = [f"p{n}x{k}x{i}" for i in range(n)]
            at = (0, 7 + 3 * k, 400)[k % 3]
            docs.append((n * 100 + k, " ".join([*words[:at], *item, *words[at:]])))
            items.append((n * 100 + k, " ".join(item)))
    found = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    same(found.select("doc_id", "item_id", "containment"), [(i, i, 1.0) for i, _ in items])


def test_vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 16))
    near = [centres[i % 6] + rng.normal(size=16) * 0.05 for i in range(900)]
    far = list(rng.normal(size=(600, 16)))
    rows = [(i, i % 2, [float(np.float32(x)) for x in v]) for i, v in enumerate(near + far)]
    rows += [(5000, 0, rows[0][2]), (5001, 1, rows[0][2]), (5002, None, rows[0][2]), (5003, 0, None), (5004, 0, [0.0] * 16)]
    rows += [(5005, 0, [float("nan")] * 16), (5006, 0, [1.0] * 3), (5007, 0, rows[0][2])]
    usable = [r for r in rows if r[1] is not None and r[2] and any(r[2]) and np.isfinite(r[2]).all()]
    links = {r[0]: 0 for r in rows}
    root = {r[0]: r[0] for r in rows}
    pairs = []
    for label in (0, 1):
        own = [r for r in usable if r[1] == label and len(r[2]) == 16]
        m = np.array([r[2] for r in own])
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        for a, b in np.argwhere(m @ m.T >= vectors.THRESHOLD):
            if a != b:
                links[own[a][0]] += 1
                pairs.append((own[a][0], own[b][0]))
    for _ in range(5):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    same(vectors.vector_duplicates(frame), [(i, links[i], root[i], root[i] == i) for i in links])
    assert vectors.vector_duplicates(frame.limit(0)).count() == 0


def test_graph_recall():
    rng = np.random.default_rng(5)
    raw = rng.normal(size=(3000, 24))
    graph = vectors.Graph(vectors.unit(raw), vectors.levels_of(np.arange(3000)))
    q = vectors.unit(rng.normal(size=(200, 24)))
    best = np.argsort(-(q @ graph.vectors.T), axis=1)[:, :10]
    found = graph.search(q, 128)[1][:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(best, found)]) >= 0.9


def test_few_links_are_found_without_scans(monkeypatch):
    rng = np.random.default_rng(12)
    raw = rng.normal(size=(20_000, 32))
    raw[:200] = raw[200:400] + rng.normal(size=(200, 32)) * 0.1
    raw = raw[rng.permutation(len(raw))] * 1e-170
    graph = vectors.Graph(vectors.unit(raw), vectors.levels_of(np.arange(len(raw))))
    beam = vectors.chosen_beam(graph)
    assert 0 < beam <= vectors.WIDEST
    scanned, scan = [0], vectors._scan
    monkeypatch.setattr(vectors, "_scan", lambda g, q, least: scanned.append(len(q)) or scan(g, q, least))
    some = rng.permutation(len(raw))[:4000]
    found = {(some[a], b) for r, c in vectors.block_links(graph, raw, raw[some], vectors.THRESHOLD, beam) for a, b in zip(r.tolist(), c.tolist())}
    m = vectors.unit(raw)
    expected = {(some[a], b) for a, b in np.argwhere(m[some] @ m.T >= vectors.THRESHOLD).tolist()}
    assert len(found & expected) / len(expected) >= 0.99 and len(expected - {(i, i) for i in some}) > 20
    assert found <= expected and sum(scanned) < 0.05 * len(some)


def test_links_hidden_by_a_broken_graph():
    rng = np.random.default_rng(7)
    hot = rng.normal(size=16) + rng.normal(size=(1000, 16)) * 0.02
    centres = rng.normal(size=(500, 16))
    pairs = np.repeat(centres, 4, axis=0) + rng.normal(size=(2000, 16)) * 0.02
    lone = rng.normal(size=(1500, 16))
    for raw in (np.concatenate([hot, pairs]), np.concatenate([pairs[:40], lone])):
        raw = raw[rng.permutation(len(raw))]
        graph = vectors.Graph(vectors.unit(raw), vectors.levels_of(np.arange(len(raw))))
        # the ground level loses the links of nine in ten
        graph.layers[0][np.arange(len(raw)) % 10 > 0] = -1
        graph.layers[0][:, vectors.LINKS // 4 :] = -1
        beam = vectors.chosen_beam(graph)
        assert beam == 0
        found = {(a, b) for r, c in vectors.block_links(graph, raw, raw, vectors.THRESHOLD, beam) for a, b in zip(r.tolist(), c.tolist())}
        m = raw / np.linalg.norm(raw, axis=1, keepdims=True)
        assert found == set(map(tuple, np.argwhere(m @ m.T >= vectors.THRESHOLD).tolist()))


def test_revisits(spark):
    record = "record_id long, warc_type string, url string, captured timestamp, status int, headers map<string,string>"
    time = lambda s: f"2024-01-01 00:00:{s:02d}"
    rows = [
        (1, "response", "http://www.a.example/x?utm_source=f#top", time(1), 200, {"etag": '"1"', "server": "s"}),
        (2, "revisit", "https://a.example/x/", time(2), 304, {"etag": '"1"', "vary": "v", "server": "t"}),
        (3, "revisit", "https://a.example/x", time(3), 304, {"etag": '"2"'}),
        (4, "response", "https://a.example/x", time(4), 404, {"etag": '"2"'}),
        (5, "revisit", "https://a.example/x", time(5), 304, {}),
        (6, "revisit", "https://b.example/", time(5), 304, {"etag": '"1"'}),
        (7, "revisit", None, time(5), 304, {"etag": '"1"'}),
        (8, "revisit", "https://a.example/x", None, 304, {"etag": '"1"'}),
    ]
    frame = spark.createDataFrame([(*r[:3], None, *r[4:]) for r in rows], record).withColumn(
        "captured", F.element_at(F.create_map(*[F.lit(x) for r in rows if r[3] for x in (r[0], r[3])]), F.col("record_id")).cast("timestamp")
    )
    found = {r["record_id"]: r for r in warc.resolve_revisits(frame).collect()}
    assert [found[i]["outcome"] for i in range(1, 9)] == [
        "full", "resolved", "mismatch", "full", "unverified", "missing", "missing", "missing",
    ]
    assert found[2]["refers_to"] == 1
    assert found[2]["merged"] == {"etag": '"1"', "vary": "v", "server": "s"}
    assert warc.resolve_revisits(frame.limit(0)).count() == 0


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_queries_against_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    frame = queries.queries()[name](spark, DATA)
    cursor = duck.execute(queries.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    expected = Counter(tuple(r[names.index(c)] for c in frame.columns) for r in cursor.fetchall())
    assert Counter(map(tuple, frame.collect())) == expected


def plain_shingles(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_pipeline(spark):
    """Against plain versions of the stages; toxicity, which is learnt, by its operator's decisions."""
    found = corpus_pipeline.run(spark, DATA)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    toxic = {r["doc_id"] for r in toxicity.toxicity(docs, labels).collect() if r["predicted"]}
    kept = plain_kept([(i, t) for i, t in rows_of(docs) if i not in toxic])
    items = [plain_shingles(r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    clean = []
    for i, text in kept:
        own = plain_shingles(text)
        if not any(item and len(item & own) / len(item) >= decontamination.THRESHOLD for item in items):
            clean.append((i, secret_scan.redacted(text)))
    library = pieces.encoder(queries.PIECE_MODEL).library
    same(found.select("doc_id", "n_tokens"), [(i, len(library.encode(t))) for i, t in clean])
    assert 0 < found.count() < docs.count()


def test_pairs_of_pieces_outlast_a_partition_and_words_do_not(monkeypatch):
    own = pieces.PrefixEncoder(queries.PIECE_MODEL)
    found = own.encode("several words of one partition")
    pairs = dict(own._side_by_side)
    own.forget()
    assert pairs and own._side_by_side == pairs and not own._cache
    assert own.encode("several words of one partition") == found and own._side_by_side == pairs
    monkeypatch.setattr(pieces, "KEPT_PAIRS", len(pairs) - 1)
    own.forget()
    assert not own._side_by_side and own.encode("several words of one partition") == found
