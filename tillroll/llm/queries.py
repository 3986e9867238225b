"""The named queries of this subpackage, with production parameters over whole tables, and
the SQL of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    centroids,
    decontamination,
    language_id,
    language_model,
    licenses,
    phrases,
    pieces,
    secret_scan,
    simhash,
    token_files,
    toxicity,
    vectors,
    warc,
)
from .common import table

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    return toxicity.toxicity(table(spark, directory, "documents"), table(spark, directory, "labels"))


def op2_licenses(spark: SparkSession, directory: str) -> DataFrame:
    return licenses.licenses(table(spark, directory, "documents"))


def op3_simhash(spark: SparkSession, directory: str) -> DataFrame:
    return simhash.simhash_duplicates(table(spark, directory, "documents"))


def op4_token_files(spark: SparkSession, directory: str) -> DataFrame:
    return token_files.token_files(spark, table(spark, directory, "documents"), WORD_TOKENIZER)


def op5_secrets(spark: SparkSession, directory: str) -> DataFrame:
    return secret_scan.secret_spans(table(spark, directory, "documents"))


def op6_language_model(spark: SparkSession, directory: str) -> DataFrame:
    return language_model.scored_texts(spark, table(spark, directory, "documents"))


def op7_pieces(spark: SparkSession, directory: str) -> DataFrame:
    return pieces.encode_pieces(table(spark, directory, "documents"), PIECE_MODEL)


def op8_vectors(spark: SparkSession, directory: str) -> DataFrame:
    return vectors.vector_duplicates(table(spark, directory, "embeddings"))


def op9_warc(spark: SparkSession, directory: str) -> DataFrame:
    return warc.revisits(spark, table(spark, directory, "pages"), f"warc-{uuid.uuid4().hex}")


def op10_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    return decontamination.contaminated(
        table(spark, directory, "documents"), table(spark, directory, "benchmark")
    )


def op11_phrases(spark: SparkSession, directory: str) -> DataFrame:
    return phrases.collocations(table(spark, directory, "documents"))


def op12_centroids(spark: SparkSession, directory: str) -> DataFrame:
    return centroids.clustered(table(spark, directory, "embeddings"))


def op13_language(spark: SparkSession, directory: str) -> DataFrame:
    return language_id.language_of(table(spark, directory, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_toxicity,
            op2_licenses,
            op3_simhash,
            op4_token_files,
            op5_secrets,
            op6_language_model,
            op7_pieces,
            op8_vectors,
            op9_warc,
            op10_decontamination,
            op11_phrases,
            op12_centroids,
            op13_language,
        )
    }


VECTOR_SQL = f"""
WITH RECURSIVE able AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.r AS a, b.r AS b
  FROM able a JOIN able b ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r
  WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v)))
        >= {vectors.THRESHOLD}
), reach AS (
  SELECT r AS a, r AS b FROM able
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), answered AS (
  SELECT a.r, a.vec_id, (SELECT count(*) FROM links WHERE links.a = a.r) AS n_links, min(b.vec_id) AS component_id
  FROM able a JOIN reach ON reach.a = a.r JOIN able b ON b.r = reach.b
  GROUP BY a.r, a.vec_id
), everything AS (
  SELECT vec_id, n_links, component_id FROM answered
  UNION ALL
  SELECT vec_id, 0, vec_id FROM embeddings
  WHERE NOT coalesce(label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false)
)
SELECT vec_id, n_links::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM everything
"""

WARC_SQL = f"""
WITH plain AS (
  SELECT coalesce(page_id, 0) AS id, coalesce(page_id, 0) % 5 AS kind, coalesce(html, '') AS html,
    regexp_replace(regexp_replace(regexp_replace(trim(nullif(url, '')), '#.*$', ''),
      '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^(www[.]|m[.])', '') AS address
  FROM pages
), pages_of AS (
  SELECT id, kind, html, regexp_replace(regexp_replace(regexp_replace(address,
      '([?&])(({warc.TRACKING})=[^&]*(&|$))+', '\\1', 'g'), '[?&]+$', ''), '/+$', '') AS canonical
  FROM plain
), records AS (
  SELECT id * 2 AS record_id, canonical, 1600000000 + id AS captured_at, true AS is_full,
    '"' || md5(html) || '"' AS etag, length(html)::VARCHAR AS changed, md5(html) AS payload_md5
  FROM pages_of
  UNION ALL
  SELECT id * 2 + 1, canonical, 1600005400 + id, kind = 4,
    CASE kind WHEN 0 THEN '"' || md5(html) || '"' WHEN 2 THEN '"other"' WHEN 4 THEN '"' || md5(html) || '"' END,
    CASE WHEN kind IN (1, 4) THEN length(html)::VARCHAR END,
    CASE WHEN kind = 4 THEN md5(html) END
  FROM pages_of
), seen AS (
  SELECT *, CASE WHEN canonical IS NOT NULL THEN last_value(CASE WHEN is_full THEN record_id END IGNORE NULLS) OVER (
      PARTITION BY canonical ORDER BY captured_at, NOT is_full, record_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS before_id
  FROM records
), judged AS (
  SELECT s.*, b.etag AS old_etag, b.changed AS old_changed,
    CASE WHEN s.is_full THEN 'full' WHEN b.record_id IS NULL THEN 'missing'
      WHEN s.etag IS NOT NULL AND b.etag IS NOT NULL
        THEN CASE WHEN s.etag = b.etag THEN 'resolved' ELSE 'mismatch' END
      WHEN s.changed IS NOT NULL AND b.changed IS NOT NULL
        THEN CASE WHEN s.changed = b.changed THEN 'resolved' ELSE 'mismatch' END
      ELSE 'unverified' END AS outcome
  FROM seen s LEFT JOIN records b ON b.record_id = s.before_id
)
SELECT record_id, canonical, captured_at, CASE WHEN is_full THEN 200 ELSE 304 END::INTEGER AS status, payload_md5,
  outcome, CASE WHEN outcome = 'resolved' THEN before_id END AS refers_to,
  CASE outcome
    WHEN 'full' THEN 'content-type: text/html\\netag: ' || etag || '\\nlast-modified: ' || changed || '\\nserver: a'
    WHEN 'resolved' THEN 'cache-control: max-age=60\\ncontent-type: text/html\\netag: ' || old_etag
      || '\\nlast-modified: ' || old_changed || '\\nserver: a' END AS merged_headers
FROM judged
""".replace("\\n", "' || chr(10) || '")

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
DECONTAMINATION_SQL = f"""
WITH doc_words AS (
  SELECT DISTINCT doc_id, md5(coalesce(text, '')) AS k, {_WORDS} AS w FROM documents
), item_words AS (
  SELECT DISTINCT item_id, md5(coalesce(text, '')) AS k, {_WORDS} AS w FROM benchmark
), doc_shingles AS (
  SELECT DISTINCT doc_id, k, array_to_string(w[i : i + least(4, len(w) - 1)], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM doc_words WHERE len(w) > 0)
), item_shingles AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i : i + least(4, len(w) - 1)], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM item_words WHERE len(w) > 0)
), sizes AS (
  SELECT item_id, k, count(*) AS n_shingles FROM item_shingles GROUP BY ALL
), shared AS (
  SELECT d.doc_id, d.k AS dk, i.item_id, i.k, count(*) AS n_shared
  FROM doc_shingles d JOIN item_shingles i USING (shingle) GROUP BY ALL
)
SELECT DISTINCT doc_id, s.item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM shared s JOIN sizes z ON s.item_id IS NOT DISTINCT FROM z.item_id AND s.k = z.k
WHERE n_shared / n_shingles >= {decontamination.THRESHOLD}
"""


PHRASE_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT row_number() OVER () AS p, lang,
    list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), placed AS (
  SELECT p, lang, unnest(w) AS word, unnest(range(len(w))) AS i FROM worded
), ahead AS (
  SELECT lang, word, lead(word) OVER (PARTITION BY p ORDER BY i) AS second,
    lead(word, 2) OVER (PARTITION BY p ORDER BY i) AS third
  FROM placed
), grams AS (
  SELECT lang, 1 AS k, word AS phrase FROM ahead
  UNION ALL SELECT lang, 2, word || ' ' || second FROM ahead WHERE second IS NOT NULL
  UNION ALL SELECT lang, 3, word || ' ' || second || ' ' || third FROM ahead WHERE third IS NOT NULL
), counts AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang
), found AS (
  SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w
  FROM counts WHERE k > 1 AND f >= {phrases.LEAST}
), longer AS (
  SELECT lang, part, max(f) AS f
  FROM (SELECT lang, f, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part
        FROM found WHERE k = 3)
  GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, unnest(range(1, c.k)) AS cut, c.w
  FROM found c LEFT JOIN longer l ON l.lang = c.lang AND l.part = c.phrase
  WHERE coalesce(100 * l.f < {phrases.COVERED} * c.f, true)
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, l.f AS l, r.f AS r,
    (1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : c.cut], ' ') AND l.k = c.cut
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1 :], ' ') AND r.k = len(c.w) - c.cut
), least AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least
)
SELECT r.lang, r.rank::BIGINT AS rank, r.phrase, r.a::BIGINT AS a, r.l::BIGINT AS l, r.r::BIGINT AS r,
  t.n::BIGINT AS n, r.score::BIGINT AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= {phrases.TOP}
"""


def _centroid_sql() -> str:
    """The rounds of centroid clustering, one after the other; the tables are small where SQL is run."""
    size = centroids.SIZE
    steps = [
        f"""able AS (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: floor({centroids.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""c0 AS (
  SELECT (row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || coalesce(vec_id::VARCHAR, '')), v) - 1) AS k, v AS c
  FROM able QUALIFY k < {centroids.CLUSTERS}
)""",
    ]
    for turn in range(centroids.ROUNDS + 1):
        steps.append(f"""a{turn} AS MATERIALIZED (
  SELECT row, vec_id, v, k, list_sum(list_transform(list_zip(v, c), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d
  FROM able, c{turn} QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, k) = 1
)""")
        if turn < centroids.ROUNDS:
            steps.append(f"""s{turn} AS (
  SELECT k, pos, sum(x) AS s, count(*) AS n
  FROM (SELECT k, unnest(v) AS x, unnest(range(1, {size + 1})) AS pos FROM a{turn}) GROUP BY k, pos
), m{turn} AS (
  SELECT k, list(((s - (((s % n) + n) % n)) // n)::BIGINT ORDER BY pos) AS c FROM s{turn} GROUP BY k
), c{turn + 1} AS MATERIALIZED (
  SELECT o.k, coalesce(m.c, o.c) AS c FROM c{turn} o LEFT JOIN m{turn} m ON m.k = o.k
)""")
    last = centroids.ROUNDS
    return "WITH " + ", ".join(steps) + f"""
SELECT a.vec_id, a.k::INTEGER AS cluster, a.d::BIGINT AS distance,
  (sum(a.d) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{last} a JOIN c{last} c ON c.k = a.k
"""


CENTROID_SQL = _centroid_sql()


def oracle_sql() -> dict[str, str]:
    return {
        "op8_vectors": VECTOR_SQL,
        "op9_warc": WARC_SQL,
        "op10_decontamination": DECONTAMINATION_SQL,
        "op11_phrases": PHRASE_SQL,
        "op12_centroids": CENTROID_SQL,
    }
