"""The registered queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    collocation, decontaminate, exact, extract, katz, packing, ranked_search, simhash, token_count, token_store, toxicity,
    units, vector_search,
)

VOCABULARY = "word_bpe_49k.json"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), vocabulary())


def op2_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_corpus(read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, read(spark, sf_dir, "labels")))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicate_groups(read(spark, sf_dir, "documents"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(read(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.round_trip(read(spark, sf_dir, "documents"), vocabulary())


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(read(spark, sf_dir, "documents"), vocabulary())


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_text(read(spark, sf_dir, "pages"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.remove_repeats(read(spark, sf_dir, "documents"))


def op11_phrase_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(read(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.nearest(read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_katz_backoff, op3_toxicity, op4_exact_dedup, op5_simhash_near_dedup, op6_decontamination,
    op7_token_store, op8_token_counts, op9_html_extraction, op10_substring_dedup,
    op11_phrase_collocation, op12_ranked_search, op13_vector_search,
)}

ORACLES = {
    "op4_exact_dedup": r"""
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
WINDOW g AS (PARTITION BY norm)""",
    "op11_phrase_collocation": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
    FROM w, (VALUES (1), (2), (3), (4)) sizes(k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 30),
held AS (
    SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer
    FROM c, (VALUES (2), (3)) sizes(m), (VALUES (1), (2), (3)) starts(i)
    WHERE m < k AND i + m - 1 <= k GROUP BY ALL),
cuts AS (
    SELECT c.lang, c.phrase, c.a, j, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
    FROM c JOIN (VALUES (1), (2), (3)) cut(j) ON j < c.k
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:j], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[j + 1:c.k], ' ')
    LEFT JOIN held ON held.lang = c.lang AND held.phrase = c.phrase
    WHERE held.longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * c.a),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
    "op12_ranked_search": r"""
WITH t AS (
    SELECT row_number() OVER () AS pos, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
d AS (SELECT pos, doc_id, len(terms) AS n FROM t WHERE len(terms) > 0),
g AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM d),
p AS (SELECT pos, term, count(*) AS tf FROM (SELECT pos, unnest(terms) AS term FROM t) GROUP BY ALL),
w AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM p, g GROUP BY term, docs),
q AS (
    SELECT DISTINCT item, item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)),
s AS (
    SELECT item, item_id, pos, doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
    FROM q JOIN p USING (term) JOIN w USING (term) JOIN d USING (pos), g
    GROUP BY item, item_id, pos, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10""",
}
