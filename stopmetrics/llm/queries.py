"""Registered queries of the training-data operators over the given tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopmetrics.llm import (
    byte_bpe,
    line_dedup,
    merkle,
    minhash,
    packing,
    quality,
    simhash,
    suffix_dedup,
    token_alignment,
    token_files,
    toxicity,
    vector_codes,
    voronoi,
)
from stopmetrics.llm.samples import is_held_out
from stopmetrics.scratch import new_folder

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    tokenizer = public_tokenizers.path(WORD_TOKENIZER)
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path, tokenizer, end_id=2)
    files = token_files.read_token_files(spark, path)
    return token_files.with_starts(token_files.token_digests(files), files, "ids_crc32")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_chunks(docs, divisor=4, least_lines=2)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), width=50)
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", "predicted")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = (public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.round_trip(docs, *vocabulary).select("doc_id", "coded.*")
    return coded.select(
        "doc_id",
        F.expr("CAST(length(ids) DIV 4 AS LONG)").alias("n_tokens"),
        "ids_sha256",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three grades from the labels: 2 for good quality without toxicity, 1 for one of the two, 0 for neither.
    `tail_probability` is P(grade >= 2), by which documents are selected; `least_probability` is P(grade >= 1)."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels")
    rated = labels.select("doc_id", (F.col("quality") + 1 - F.col("toxic")).alias("rating"))
    model = quality.fit_quality(docs, rated, rating="rating", grades=3)
    scored = quality.score_quality(docs, model, tail_from=2)
    return scored.select(
        "doc_id",
        is_held_out().alias("held_out"),
        "expected_grade",
        "tail_probability",
        F.element_at("tail_probabilities", 1).alias("least_probability"),
        (F.col("tail_probability") >= 0.5).cast("int").alias("keep"),
    )


def op7_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_with_edit(_table(spark, sf_dir, "documents"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), words_per_shingle=3, radius=3)
    fingerprint = F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", fingerprint, "component_id")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path(WORD_TOKENIZER),
        end_id=1,
        capacity=4096,
        with_ids=False,
    )
    return packed.drop("ids")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.encode(_table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_corpus(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECES)
    )


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words_per_shingle=2, percent=80)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_token_files,
        op2_line_dedup,
        op3_suffix_dedup,
        op4_toxicity,
        op5_byte_bpe,
        op6_quality,
        op7_merkle_fingerprints,
        op8_top_k,
        op9_simhash_near_dedup,
        op10_best_fit_packing,
        op11_vector_codes,
        op12_token_alignment,
        op13_minhash_near_dedup,
    )
    return {query.__name__: query for query in named}


_OP2 = """
WITH cut AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
    SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM cut
), hashed AS (
    SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM line
), ended AS (
    SELECT *, CAST((h + 31 * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0)) % 4 = 0 AS INTEGER) AS ends FROM hashed
), numbered AS (
    SELECT *, coalesce(sum(ends) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
    FROM ended
), chunk AS (
    SELECT doc_id, place, string_agg(line, chr(10) ORDER BY i) AS piece, count(*) FILTER (WHERE length(trim(line)) > 0) AS filled
    FROM numbered GROUP BY doc_id, place
), judged AS (
    SELECT *, filled >= 2 AND row_number() OVER (PARTITION BY piece, filled >= 2 ORDER BY doc_id, place) > 1 AS gone FROM chunk
), joined AS (
    SELECT doc_id, coalesce(string_agg(piece, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS kept,
        CAST(count(*) AS INTEGER) AS n_chunks, CAST(count(*) FILTER (WHERE gone) AS INTEGER) AS n_removed
    FROM judged GROUP BY doc_id
)
SELECT doc_id, CASE WHEN n_removed = 0 THEN text ELSE kept END AS text, n_chunks, n_removed
FROM joined JOIN documents USING (doc_id)
"""

_OP8 = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.v, x.v) AS BIGINT) AS score
    FROM usable q JOIN usable x ON q.vec_id % 20 = 0 AND q.vec_id <> x.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""



def _nearest_entries(parts: str, book: str) -> str:
    """Each part with its nearest entry and their squared distance."""
    return f"""
    SELECT vec_id, p, any_value(part) AS part, min(far * 256 + e) % 256 AS e, min(far * 256 + e) // 256 AS far FROM (
        SELECT vec_id, p, part, e, CAST(list_sum(list_transform(list_zip(part, entry), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS far
        FROM {parts} JOIN {book} USING (p)
    ) GROUP BY vec_id, p"""


def _mean_entries(members: str, book: str) -> str:
    """Every entry as the componentwise floor of its members' mean; without members it stays."""
    return f"""
    SELECT p, e, coalesce(mean, entry) AS entry FROM {book} LEFT JOIN (
        SELECT p, e, list(mean ORDER BY i) AS mean FROM (
            SELECT p, e, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS mean
            FROM (SELECT p, e, unnest(part) AS x, unnest(range(len(part))) AS i FROM {members}) GROUP BY p, e, i
        ) GROUP BY p, e
    ) USING (p, e)"""


_OP11 = f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
    SELECT vec_id, label, p, v[p * len(v) // 16 + 1 : (p + 1) * len(v) // 16] AS part FROM kept, range(16) AS t(p)
), seeds AS (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64
), book0 AS (
    SELECT p, e, part AS entry FROM parts JOIN seeds USING (vec_id)
), members0 AS ({_nearest_entries("parts", "book0")}
), book1 AS ({_mean_entries("members0", "book0")}
), members1 AS ({_nearest_entries("parts", "book1")}
), book2 AS ({_mean_entries("members1", "book1")}
), final AS ({_nearest_entries("parts", "book2")}
), coded AS (
    SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error
    FROM final GROUP BY vec_id
), digest AS (
    SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
    FROM (SELECT p, e, unnest(entry) AS x, unnest(range(len(entry))) AS i FROM book2)
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": _OP2, "op8_top_k": _OP8, "op11_vector_codes": _OP11}
