"""Languages by compression: held-out accuracy and awkward rows."""

import zlib

from tillroll.llm import language_id

SCHEMA = "doc_id long, text string, lang string, score double, held_out string, h long"


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    found = language_id.language_of(docs).collect()
    assert len(found) == len(rows)
    right = []
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        row = rows[r["doc_id"]]
        if r["held_out"] and row["lang"] and any(c.isalpha() for c in row["text"] or ""):
            right.append(r["lang_pred"] == row["lang"])
    assert len(right) > 150 and sum(right) / len(right) >= 0.98


def test_languages_are_never_read_where_texts_are_scored(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    told = {r["doc_id"]: r for r in language_id.language_of(docs).collect()}
    held = [i for i, r in told.items() if r["held_out"]]
    other = docs.selectExpr("doc_id", "text", f"if(doc_id in ({','.join(map(str, held))}), 'xx', lang) AS lang", "'s' AS source")
    assert {r["doc_id"]: r for r in language_id.language_of(other).collect()} == told


def test_awkward_rows(spark):
    english = "the cat and the dog were walking with their owner through the park"
    german = "die Katze und der Hund gingen mit ihrem Besitzer durch den Park"
    rows = [(i, f"{t} {i}", lang, 0.0, "x", 1) for i, (t, lang) in enumerate([(english, "en"), (german, "de")] * 40)]
    asked = [(1000, None), (1001, ""), (1002, "12 - 34 !"), (1003, "über den Hund"), (None, english), (1004, german * 3000), (1004, german * 3000), (1005, "٣ ²")]
    rows += [(i, t, None, 0.0, "x", 1) for i, t in asked]
    found = {}
    for r in language_id.language_of(spark.createDataFrame(rows, SCHEMA)).collect():
        found.setdefault(r["doc_id"], []).append(r["lang_pred"])
    assert [found[i] for i in (1000, 1001, 1002, 1005)] == [["und"]] * 4
    assert found[None] == ["en"] and found[1003] == ["de"] and found[1004] == ["de"] * 2
    nothing = spark.createDataFrame([r for r in rows if r[2] is None], SCHEMA)
    assert {(r["lang_pred"], r["score"]) for r in language_id.language_of(nothing).collect()} == {("und", 0.0)}
    assert language_id.language_of(nothing.limit(0)).count() == 0


def test_narrow_leads_are_rejected(spark):
    pieces = {"a": b"alpha beta gamma delta " * 40, "b": b"alpha beta gamma delta " * 40, "c": b"other words at all " * 40}
    frame = spark.createDataFrame([(1, "alpha beta gamma"), (2, "other words at all, all other words")], "doc_id long, text string")
    found = {r["doc_id"]: (r["lang_pred"], r["accepted"]) for r in language_id.identify(frame, pieces).collect()}
    assert found == {1: ("a", False), 2: ("c", True)}
    named = language_id.rejected_as_unknown(language_id.identify(frame, pieces)).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in named} == {1: "und", 2: "c"}


def test_dictionaries_are_bounded():
    content = language_id.dictionary([b"word " * 5000, b"other " * 9000])
    assert len(content) <= language_id.CONTENT + 16
