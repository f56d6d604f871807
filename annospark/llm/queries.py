"""The queries of this subpackage: each operator on its whole table, reduced to the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontam, filter_audit, langid, minhash, mixing, quality, secrets, source_audit, suffix_dedup, token_counts, token_output, warc
from .common import id_remainder, shared_folder, ship_package

#: The part of documents, by crc32 of the id modulo 4, that no model learns from.
HELD_OUT = 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), _tokenizer()).withColumn("over_limit", F.col("n_tokens") > 1024)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=400).drop("kept")


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = mixing.quality_weight(_table(spark, sf_dir, "labels"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count().alias("size")).join(weights, "doc_id", "left")
    return mixing.mix(docs, weights=(3, 1, 2), share=1.5, max_epochs=2, size=F.col("size"), quality=F.col("quality_weight"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_remainder() == HELD_OUT, F.lit(False))  # an unknown id has no remainder
    model = quality.learn(docs, _table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out))
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), percent=85, size=5)


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    token_output.write_ids(docs, path := shared_folder(spark, "token-ids"), _tokenizer(), end_id=0)
    return token_output.read_ids(spark, path)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(id_remainder() == HELD_OUT, F.lit(False))  # an unknown id has no remainder
    profiles = langid.learn_profiles(docs.where(~held_out))
    return langid.identify(docs.select("doc_id", "text"), profiles).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(_table(spark, sf_dir, "documents")))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.cells(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")), list(filter_audit.FILTERS))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergence(_table(spark, sf_dir, "documents"), min_docs=3, top=200)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    warc.write_pages(_table(spark, sf_dir, "pages"), path := shared_folder(spark, "warc"), revisit_bytes=0)
    return warc.read_pages(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_ann, op2_token_counts, op3_decontaminate, op4_suffix_dedup, op5_mix, op6_quality, op7_minhash, op8_token_output, op9_language, op10_secrets, op11_filter_audit, op12_source_divergence, op13_warc)}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_decontaminate": decontam.DECONTAM_SQL, "op5_mix": mixing.MIX_SQL, "op7_minhash": minhash.NEAR_SQL, "op11_filter_audit": filter_audit.AUDIT_SQL,
        "op12_source_divergence": source_audit.DIVERGENCE_SQL, "op13_warc": warc.WARC_SQL,
    }
