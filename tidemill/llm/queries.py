"""The operators on the test tables, under the names they are registered by."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import (
    anchor_cover,
    decontamination,
    language,
    line_runs,
    passage_chains,
    prefix_forest,
    quality_trees,
    sharded_lloyd,
    source_mix,
    superminhash,
    token_counts,
    toxicity,
    vector_codes,
    vector_sql,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    scored = quality_trees.score_quality(documents, labels)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op3_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passage_chains.repeated_passages(_table(spark, folder, "documents"))


def op4_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_forest.nearest(_table(spark, folder, "embeddings"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    scored = toxicity.score_toxicity(documents, labels)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return superminhash.near_duplicates(_table(spark, folder, "documents"), size=2, percent=80)


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = token_counts.count_tokens(_table(spark, folder, "documents"), path)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = source_mix.mix(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    found = language.predict_language(_table(spark, folder, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op10_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = line_runs.remove_repeated_lines(_table(spark, folder, "documents"), min_words=50)
    return cleaned.select("doc_id", "n_lines", "n_removed", "text")


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, codebooks = vector_codes.encode(_table(spark, folder, "embeddings"))
    code = F.array_join(F.transform("codes", lambda entry: F.lpad(F.lower(F.hex(entry)), 2, "0")), "")
    digest = F.lit(vector_codes.codebooks_sha256(codebooks))
    return coded.select("vec_id", code.alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))


def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = anchor_cover.near_fingerprints(_table(spark, folder, "documents"))
    shown = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", shown.alias("fingerprint"), "component_id")


def op13_clusters(spark: SparkSession, folder: str) -> DataFrame:
    found = sharded_lloyd.cluster(_table(spark, folder, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_decontamination": op2_decontamination,
    "op3_passages": op3_passages,
    "op4_neighbours": op4_neighbours,
    "op5_toxicity": op5_toxicity,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_token_counts": op7_token_counts,
    "op8_source_mix": op8_source_mix,
    "op9_language": op9_language,
    "op10_line_runs": op10_line_runs,
    "op11_vector_codes": op11_vector_codes,
    "op12_fingerprints": op12_fingerprints,
    "op13_clusters": op13_clusters,
}
SQL: dict[str, str] = {
    "op11_vector_codes": vector_sql.codes(),
    "op13_clusters": vector_sql.clusters(),
    "op10_line_runs": """
        WITH lines AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS n
            FROM documents
        ), worded AS (
            SELECT doc_id, line, n, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS pos,
                   len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words
            FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
        ), matches AS (
            SELECT later.doc_id, later.n, later.pos, later.words,
                   earlier.doc_id AS source, earlier.pos - later.pos AS shift
            FROM worded later JOIN worded earlier
                ON later.line = earlier.line
                AND (earlier.doc_id < later.doc_id OR (earlier.doc_id = later.doc_id AND earlier.pos < later.pos))
        ), islands AS (
            SELECT *, pos - row_number() OVER (PARTITION BY doc_id, source, shift ORDER BY pos) AS island
            FROM matches
        ), runs AS (
            SELECT doc_id, n, sum(words) OVER (PARTITION BY doc_id, source, shift, island) AS run_words
            FROM islands
        ), gone AS (
            SELECT DISTINCT doc_id, n FROM runs WHERE run_words >= 50
        )
        SELECT lines.doc_id, count(*) AS n_lines, count(gone.n) AS n_removed,
               coalesce(string_agg(line, chr(10) ORDER BY lines.n) FILTER (gone.n IS NULL), '') AS text
        FROM lines LEFT JOIN gone ON lines.doc_id = gone.doc_id AND lines.n = gone.n
        GROUP BY lines.doc_id
    """,
}
