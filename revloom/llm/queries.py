"""The queries of the operators in this subpackage, over the test tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.llm import chat, exact_packing, hard_negatives, language_model, line_dedup, mixing, near_vectors, neighbours, ngram_join, packing, quality, resampling, warc
from revloom.llm.shared import known_to_workers

QUERIES, SQL = {}, {}

#: Distinct sources from which on a line is boilerplate.
MIN_SITES = 10
#: Of the entropy of equal weights.
TARGET_ENTROPY = 0.9995
MIXING_SEED = 17


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            known_to_workers(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_ngram_jaccard_join")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = ngram_join.linked_documents(table(spark, folder, "documents"), width=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


@query("op2_chat_formatting")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = chat.formatted(chat.message_events(rows.union(extra)), by=chat.MESSAGE_ORDER)
    return chat.read_back(turns)


@query("op3_cost_balanced_packing")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.packed(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op4_line_dedup", f"""
    WITH lines AS (
        SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS number
        FROM documents WHERE text IS NOT NULL
    ), spread AS (
        SELECT line, min((doc_id, number)) AS first FROM lines WHERE trim(line) <> '' GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}
    ), marked AS (
        SELECT l.*, s.line IS NOT NULL AND (l.doc_id, l.number) <> s.first AS gone FROM lines l LEFT JOIN spread s USING (line)
    ), texts AS (
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
               coalesce(string_agg(line, chr(10) ORDER BY number) FILTER (NOT gone), '') AS text
        FROM marked GROUP BY doc_id
    )
    SELECT d.doc_id, t.text, d.source, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed FROM documents d LEFT JOIN texts t USING (doc_id)
""")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    out = line_dedup.without_spread_lines(table(spark, folder, "documents"), MIN_SITES)
    return out.select("doc_id", "text", "source", "n_lines", "n_removed")


@query("op5_pairwise_quality")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scored(table(spark, folder, "documents"), table(spark, folder, "labels")).select("doc_id", "held_out", "score", "predicted")


@query("op6_warc_normaliser", """
    WITH sized AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
    ), targets AS (
        SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS target FROM sized
    )
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN target = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN target <> page_id THEN target END AS refers_to
    FROM targets
""")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return warc.read_back(*warc.archived(table(spark, folder, "pages")))


@query("op7_kneser_ney_scoring")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.scored(table(spark, folder, "documents"))


@query("op8_spherical_cap_links")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.linked_vectors(table(spark, folder, "embeddings"), cosine=0.98)


@query("op9_projection_forest_neighbours")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op10_temperature_mixing", f"""
    WITH sized AS (
        SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^ \\t\\n\\x0b\\f\\r]+')) END AS tokens FROM documents
    ), shares AS (
        SELECT source, sum(tokens)::BIGINT AS tokens, sum(tokens) / (SELECT sum(tokens) FROM sized)::DOUBLE AS p FROM sized GROUP BY source HAVING sum(tokens) > 0
    ), tried AS (
        SELECT k / 1048576.0::DOUBLE AS a FROM range(0, 1048577) t(k)
    ), chosen AS (
        SELECT max(a) AS a FROM (
            SELECT a, ln(sum(pow(p, a))) - sum(pow(p, a) * ln(pow(p, a))) / sum(pow(p, a)) AS entropy, count(*) AS n FROM shares, tried GROUP BY a
        ) WHERE entropy >= {TARGET_ENTROPY} * ln(n)
    ), plan AS (
        SELECT source, tokens, floor(round(pow(p, a) / sum(pow(p, a)) OVER (), 12) * (SELECT sum(tokens) FROM sized)::DOUBLE + 0.5)::BIGINT AS quota
        FROM shares, chosen
    ), ordered AS (
        SELECT s.doc_id, s.source, s.tokens, quota // p.tokens AS copies, quota % p.tokens AS rest,
               sum(s.tokens) OVER (PARTITION BY s.source ORDER BY md5(concat_ws('|', '{MIXING_SEED}', (quota // p.tokens)::VARCHAR, s.doc_id::VARCHAR)), s.doc_id::VARCHAR) AS upto
        FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
    ), times AS (
        SELECT doc_id, source, copies + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS times FROM ordered
        UNION ALL SELECT doc_id, source, 1 FROM sized s WHERE NOT EXISTS (SELECT 1 FROM plan p WHERE s.source IS NOT DISTINCT FROM p.source)
    )
    SELECT doc_id, source, copy, md5(concat_ws('|', '{MIXING_SEED}', copy::VARCHAR, coalesce(source, ''), doc_id::VARCHAR)) AS place
    FROM (SELECT doc_id, source, unnest(range(0, times::BIGINT)) AS copy FROM times)
""")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    total = docs.agg(F.sum(mixing.tokens(F.col("text")))).first()[0] or 0
    return mixing.mixed(docs, target_entropy=TARGET_ENTROPY, budget=total, seed=MIXING_SEED).select("doc_id", "source", "copy", "place")


@query("op11_target_resampling")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    drawn = resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_vertical_scan_negatives", """
    WITH usable AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
        FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
    ), positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10
""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, positives=5, negatives=10, least=30, most=90)


@query("op13_exact_complement_packing")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    pieces = exact_packing.packed(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
