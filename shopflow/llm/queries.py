"""The registered queries of the subpackage: op1 to op13 and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm import collocations as CO
from shopflow.llm import exact_dedup as ED
from shopflow.llm import hard_negatives as HN
from shopflow.llm import jaccard_join as JJ
from shopflow.llm import kneser_ney as KN
from shopflow.llm import language_id as LI
from shopflow.llm import mixing as MX
from shopflow.llm import packing as PK
from shopflow.llm import quality_rules as QR
from shopflow.llm import sentence_pieces as SP
from shopflow.llm import suffix_dedup as SD
from shopflow.llm import token_store as TS
from shopflow.llm import toxicity as TX
from shopflow.llm.common import table


# The vocabulary files of the public tokenizers; a parameter of every operator
# that needs one.
def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


PIECES_32K = "piece_bpe_32k.model"
BYTES_50K = "byte_bpe_50k.json"


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return JJ.jaccard_join(spark, table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ED.exact_dedup(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SP.round_trip(spark, table(spark, sf_dir, "documents"), vocabulary(PIECES_32K))


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = TS.write_tokens(spark, table(spark, sf_dir, "documents"), vocabulary(BYTES_50K), end=0)
    return TS.digests(spark, path)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SD.suffix_dedup(spark, table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TX.toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return KN.score(docs, KN.train(spark, docs.where(~KN.held_out())))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LI.language_id(spark, table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PK.pack(spark, table(spark, sf_dir, "documents"), vocabulary(BYTES_50K), end=1)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = QR.quality_rules(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))
    return HN.hard_negatives(spark, vectors, vec_id % 100 == 0)


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MX.mix(spark, table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CO.collocations(spark, table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_sentence_pieces": op3_sentence_pieces,
    "op4_token_store": op4_token_store,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_kneser_ney": op7_kneser_ney,
    "op8_language_id": op8_language_id,
    "op9_packing": op9_packing,
    "op10_quality_rules": op10_quality_rules,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_mixing": op12_mixing,
    "op13_collocations": op13_collocations,
    "pipeline": pipeline,
}

# Statements DuckDB can run on the same tables; the others are tested against
# brute-force versions in tests/llm.
ORACLE: dict[str, str] = {
    "op2_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                          regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS b FROM documents),
             k AS (SELECT b, count(*) AS group_size,
                          first(doc_id ORDER BY length(t) DESC, doc_id) AS keep_id FROM d GROUP BY b)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(b) AS text_sha256
        FROM d JOIN k USING (b)""",
    "op11_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             pairs AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                              CAST(list_dot_product(a.q, b.q) AS BIGINT) AS s
                       FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
             pos AS (SELECT anchor_id, other_id AS positive_id, s AS positive_score FROM pairs WHERE same
                     QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, other_id) <= 5)
        SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, s AS negative_score,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, other_id) AS INTEGER) AS rank
        FROM pos JOIN pairs USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * s AND 100 * s <= 90 * positive_score
        QUALIFY rank <= 10""",
    "op13_collocations": """
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
             w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
             totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
             grams AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2),
                              lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
                       FROM w, (VALUES (1), (2), (3), (4), (5)) AS t(m) WHERE len(w) >= m),
             f AS (SELECT lang, m, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM grams
                   GROUP BY lang, m, phrase HAVING count(*) >= 100),
             longer AS (SELECT lang, f, unnest([array_to_string(w[1:m - 1], ' '), array_to_string(w[2:m], ' ')]) AS phrase
                        FROM f WHERE m > 2),
             kept AS (SELECT * FROM f WHERE m > 1 AND NOT EXISTS (SELECT 1 FROM longer AS o
                      WHERE o.lang = f.lang AND o.phrase = f.phrase AND o.f >= f.f)),
             cuts AS (SELECT lang, phrase, f AS a, w, m, unnest(range(1, m)) AS k FROM kept),
             scored AS (SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n,
                               (CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(x.f AS HUGEINT) * y.f) AS score
                        FROM cuts c JOIN totals t USING (lang)
                        JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
                        JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')),
             best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, CAST(score AS BIGINT) AS score
        FROM best QUALIFY rank <= 2000""",
}
