"""The operators as registered queries over whole tables; each entry is (query, oracle SQL or None)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, embeddings, hard_negatives, hmm, infill, licenses, lines, quality, simhash, token_files, toxicity, warc
from tidemark.llm.common import fold, load
from tidemark.llm.sample import HELD_OUT_FOLD
from tidemark.session import new_folder


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the share of its words that lies in benchmark windows."""
    rows = decontaminate.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return rows.select(
        F.col("key").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


DECONTAMINATION_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
parts AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS part
  FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(generate_series(1, len(w) - least(len(w), 13) + 1)) AS i
        FROM items WHERE len(w) > 0)),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS part
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM words, (SELECT DISTINCT n FROM parts) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM places JOIN parts USING (n, part)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""


def _judged(rows: DataFrame, accept: float) -> DataFrame:
    rows = rows.withColumnRenamed("key", "doc_id")
    return rows.select("doc_id", (fold() == HELD_OUT_FOLD).alias("held_out"), "score", (F.col("score") >= accept).cast("int").alias("predicted"))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's chance of being toxic; 0.5 is the threshold of its language."""
    docs = load(spark, sf_dir, "documents")
    return _judged(toxicity.score_documents(docs, toxicity.train(docs, load(spark, sf_dir, "labels"))), 0.5)


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer: below TOKENIZERS_DIR if that is set, else where its package has it."""
    if folder := os.environ.get("TOKENIZERS_DIR"):
        return f"{folder}/{name}"
    import public_tokenizers

    return str(public_tokenizers.path(name))


def bpe_digests(docs: DataFrame, *keep: str) -> DataFrame:
    """Digests of the ids and of the text decoded from them; `keep` names further columns."""
    rows = bpe.roundtrip(docs, tokenizer_file("word_bpe_49k.json"))
    return rows.select(
        "doc_id", *keep, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return bpe_digests(load(spark, sf_dir, "documents").select("doc_id", "text"))


def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the written token files, its length and checksum as read back."""
    path = new_folder(spark, "tokens")
    token_files.write_tokens(load(spark, sf_dir, "documents"), path, tokenizer_file("byte_bpe_50k.json"))
    rows = token_files.read_tokens(spark, path, with_ids=False)
    return rows.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's chance of being good."""
    docs = load(spark, sf_dir, "documents")
    return _judged(quality.score_documents(docs, quality.train(docs, load(spark, sf_dir, "labels"))), quality.ACCEPT)


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the smallest document of its group."""
    rows = simhash.simhash_components(load(spark, sf_dir, "documents"))
    return rows.select(F.col("key").alias("doc_id"), simhash.hex16().alias("fingerprint"), F.col("component").alias("component_id"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated lines."""
    return lines.drop_repeated_lines(load(spark, sf_dir, "documents"), n_chars="n_chars", short_copies=True)


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its number of near vectors of the same label and its group."""
    rows = embeddings.near_vectors(load(spark, sf_dir, "embeddings"))
    return rows.select(F.col("key").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


LM_HELD_OUT_FOLD = 1


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability by the hidden Markov model and by single words."""
    rows = hmm.score_corpus(load(spark, sf_dir, "documents"), fold() != LM_HELD_OUT_FOLD).withColumnRenamed("key", "doc_id")
    return rows.select("doc_id", (fold() == LM_HELD_OUT_FOLD).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the licences whose notices it holds, the best coefficient, and the coefficient and lines of each."""
    rows = licenses.scan_documents(load(spark, sf_dir, "documents"))
    return rows.select(
        F.col("key").alias("doc_id"), F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join("licenses.name", ",").alias("licenses"), F.array_max("licenses.dice").alias("best_dice"), F.col("licenses").alias("found"))


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fill-in-the-middle form, with digests of the output and of the text rebuilt from it."""
    rows = infill.infill(load(spark, sf_dir, "documents"))
    return rows.select(
        F.col("key").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(infill.restored(), 256).alias("restored_sha256"))


FILL_IN_MIDDLE_SQL = r"""
WITH tokens AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
draws AS (
  SELECT doc_id, text, w, len(w) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(w) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(w) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM tokens),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(w[1:least(a, b)], '') AS p,
         array_to_string(w[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(w[greatest(a, b) + 1:], '') AS s FROM draws)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
              ELSE text END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts"""


def mine_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, after every seventh row's label has been moved on."""
    rows = load(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved))


HARD_NEGATIVES_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
anchors AS (SELECT vec_id AS anchor_id, label AS own, v AS a FROM rows WHERE vec_id % 100 = 0),
scores AS (
  SELECT anchor_id, vec_id, own = label AS same, CAST(list_inner_product(a, v) AS BIGINT) AS score
  FROM anchors, rows WHERE vec_id <> anchor_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5"""


def warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as its record in the written archives says."""
    path = new_folder(spark, "warc")
    warc.write_warc(load(spark, sf_dir, "pages"), path, "2024-01-01T00:00:00Z")
    rows = warc.read_warc(spark, path, with_payload=False)
    return rows.select(
        warc.key_of("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.key_of("refers_to").cast("long").alias("refers_to"))


WARC_SQL = """
WITH sums AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
digests AS (
  SELECT page_id, payload_bytes, translate(array_to_string(list_transform(range(0, 8),
           lambda i: to_base(CAST('0x' || substr(h, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT), 32, 4)), ''),
         '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest FROM sums),
firsts AS (SELECT payload_digest, payload_bytes, min(page_id) AS first FROM digests GROUP BY payload_digest, payload_bytes)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM digests JOIN firsts USING (payload_digest, payload_bytes)"""


QUERIES = {
    "op1_decontamination": (decontamination, DECONTAMINATION_SQL),
    "op2_toxicity": (toxicity_scores, None),
    "op3_bpe_roundtrip": (bpe_roundtrip, None),
    "op4_quality_classifier": (quality_scores, None),
    "op5_line_dedup": (line_dedup, None),
    "op6_embedding_near_dedup": (embedding_near_dedup, None),
    "op7_token_output": (token_output, None),
    "op8_simhash_near_dedup": (simhash_near_dedup, None),
    "op9_lm_scoring": (lm_scores, None),
    "op10_license_scan": (license_scan, None),
    "op11_fill_in_middle": (fill_in_middle, FILL_IN_MIDDLE_SQL),
    "op12_hard_negatives": (mine_hard_negatives, HARD_NEGATIVES_SQL),
    "op13_warc_roundtrip": (warc_roundtrip, WARC_SQL),
}
