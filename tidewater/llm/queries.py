"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import alignment, decontaminate, embedding_dedup, kn_quality, lattice, licenses, mixing, ngram_join, pii, spelling, token_counts, token_files, url_rules
from tidewater.llm.sql import SQL as SQL  # for __spark_entry__.py

#: The tokenizer files are installed with the public package; only their path is used.
BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_ids(table(spark, sf_dir, "documents"), tokenizer_path(BPE))
    return token_files.read_ids(manifest)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_scan(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


#: Key of the registered query and the pipeline; a real run brings its own.
PII_KEY = "tidewater-example-key"


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY, count_as="n_replaced")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "kept")


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op7_kn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = kn_quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "lang", "__judged.*")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op9_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text, decode the pieces again and compare."""
    model = tokenizer_path(PIECES)
    coded = lattice.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model, decoded="decoded")
    return coded.select("doc_id", "pieces", F.size("pieces").cast("long").alias("n_pieces"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(BPE))


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path(BPE), tokenizer_path(PIECES)).documents


QUERIES = {f.__name__: f for f in (op1_embedding_dedup, op2_token_files, op3_license_scan, op4_surrogates, op5_ngram_jaccard, op6_url_rules, op7_kn_quality, op8_decontamination, op9_sampled_pieces, op10_token_counts, op11_source_mix, op12_spelling_variants, op13_tokenizer_alignment)}
