"""The registered queries of the operators: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.llm import (
    bpe, collocations, exact_dedup, metric_tree, packing, pii, quality, sharding, simhash, substring_dedup, toxicity, warc, whitening,
)
from commerce_lake.llm.common import documents


EXACT_DEDUP_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM d WINDOW g AS (PARTITION BY norm)
"""


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS target FROM p)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN strlen(payload) >= 1000 AND page_id < target THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(payload) >= 1000 AND page_id < target THEN target END AS refers_to
FROM q
"""

QUALITY_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
places AS (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM d),
often AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, list_slice(words, i, i + 7)) AS n FROM places),
gaps AS (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS new FROM often WHERE n > 1),
repeats AS (SELECT doc_id, CAST(sum(new) AS BIGINT) AS n FROM gaps GROUP BY 1),
counted AS (
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals, len(lines) AS n_lines
  FROM d LEFT JOIN repeats r ON d.doc_id = r.doc_id
),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 2 * n_capitals > word_chars OR 10 * n_dup_lines > 3 * n_lines) AS kept
FROM judged
"""


NEAREST_SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, q.r AS r, c.vec_id AS vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.r <> c.r
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
"""


COLLOCATIONS_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(list_slice(words, i, i + k - 1), ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3)) AS o(k) WHERE len(words) >= k
),
f AS (SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY 1, 2, 3),
totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1),
often AS (SELECT * FROM f WHERE n >= 10),
parts AS (
  SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS words, unnest(range(1, k)) AS cut FROM often WHERE k > 1
),
cuts AS (
  SELECT c.lang AS lang, c.k AS k, c.phrase AS phrase, a, cut, l.n AS l, r.n AS r,
         CAST(1000000::HUGEINT * a * a // (l.n::HUGEINT * r.n) AS BIGINT) AS score
  FROM parts c JOIN often l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(words, 1, cut), ' ')
       JOIN often r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(words, cut + 1, c.k), ' ')
),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM cuts) WHERE nth = 1),
longer AS (
  SELECT lang, a, unnest([array_to_string(list_slice(words, 1, 2), ' '), array_to_string(list_slice(words, 2, 3), ' ')]) AS phrase
  FROM parts WHERE k = 3 AND cut = 1
),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best b WHERE NOT EXISTS (SELECT 1 FROM longer x WHERE x.lang = b.lang AND x.phrase = b.phrase AND 100 * x.a >= 50 * b.a)
)
SELECT r.lang AS lang, rank, phrase, a, l, r.r AS r, t.n AS n, score
FROM ranked r JOIN totals t ON r.lang = t.lang WHERE rank <= 2000
"""


def op1_bpe_encode_decode(spark: SparkSession, folder: str) -> DataFrame:
    decoded = bpe.encode_decode(documents(spark, folder), bpe.public_vocabulary())
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_warc_bundles(spark: SparkSession, folder: str) -> DataFrame:
    read = warc.round_trip(spark.read.parquet(f"{folder}/pages.parquet"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder))


def op4_sampled_splitters(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(documents(spark, folder))


def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(documents(spark, folder))


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder), bpe.public_vocabulary())


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet")))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, folder))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(documents(spark, folder))


def op10_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup.remove_repeats(documents(spark, folder))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_m_tree_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return metric_tree.nearest(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(documents(spark, folder))


def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {name: f for name, f in globals().items() if name.startswith("op")}
    return dict(sorted(named.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return {"op2_warc_bundles": WARC_SQL, "op8_exact_dedup": EXACT_DEDUP_SQL, "op9_quality_rules": QUALITY_SQL, "op11_m_tree_top_k": NEAREST_SQL,
            "op12_collocations": COLLOCATIONS_SQL}
