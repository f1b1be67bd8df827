"""The document operators as registered queries; each reads its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fringeline.llm import chat, chunk_codec, decontaminate, divergence, exact_dedup, hard_negatives, license_scan, mixing, pii, sharding, simhash, token_count, toxicity
from fringeline.llm.common import read


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_count.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(read(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(read(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    probe = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(r"\### Assistant: </turn> ok").alias("text"))
    return chat.read_back(chat.examples(talks.unionByName(probe.select(*[F.col(c).cast(kind) for c, kind in talks.dtypes]))))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(read(spark, sf_dir, "documents"))


def op10_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(read(spark, sf_dir, "documents"))


def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return chunk_codec.report(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, sf_dir, "embeddings").withColumn("label", label))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_pii, op3_token_counts, op4_decontaminate, op5_mixing, op6_sharding, op7_chat, op8_toxicity, op9_exact_dedup, op10_license, op11_bpe_codec, op12_divergence, op13_hard_negatives)}

#: Where SQL can express a query; the others are tested against plain Python versions.
ORACLE_SQL = {
    "op7_chat": r"""WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n, count(*) OVER (PARTITION BY conv_id) AS total,
          length('<turn ' || role || '>') + 1 + length(regexp_replace(text, '<(\\*)(/?turn)', '<\\\1\2', 'g')) + length('</turn>') + 1 AS chars FROM c),
        q AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS prefix FROM p)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
          CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
          CAST(sum(prefix) FILTER (WHERE role = 'assistant' OR n = total) AS BIGINT) AS formatted_chars
        FROM q GROUP BY conv_id""",
    "op12_divergence": r"""WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
        g AS (SELECT DISTINCT lang, source FROM d),
        k AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(words)) AS term FROM d) GROUP BY 1, 2 HAVING count(*) >= 30),
        c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM (SELECT lang, source, unnest(words) AS term FROM d) w JOIN k ON k.lang = w.lang AND k.term = w.term GROUP BY 1, 2, 3),
        v AS (SELECT lang, count(*) AS terms FROM k GROUP BY 1), t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY 1, 2),
        p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5) // (coalesce(t.total, 0) + 5 * v.terms) AS p
          FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN t ON t.lang = g.lang AND t.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        q AS (SELECT k.lang, k.term, 1 + CAST(1000000000 AS HUGEINT) * (l.n + 5) // (a.total + 5 * v.terms) AS q FROM k JOIN v ON v.lang = k.lang
          JOIN (SELECT lang, term, sum(n) AS n FROM c GROUP BY 1, 2) l ON l.lang = k.lang AND l.term = k.term JOIN (SELECT lang, sum(n) AS total FROM c GROUP BY 1) a ON a.lang = k.lang),
        s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY 1, 2, 3),
        f AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
        h AS (SELECT p.lang, p.source, p.term AS item, CAST(p.p - q.q AS BIGINT) AS value FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q)
        SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM f
        UNION ALL SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM h) WHERE rank <= 50""",
    "op13_hard_negatives": """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
          FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score FROM e a JOIN e r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5""",
    "op9_exact_dedup": r"""WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS flat FROM documents),
        g AS (SELECT flat, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY flat)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(flat) AS text_sha256 FROM t JOIN g USING (flat)""",
}
