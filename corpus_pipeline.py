"""Corpus pipeline: language ID, near-dedup, decontamination, mixing to target weights, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.llm import decontam, langid, minhash, mixing, token_output
from annospark.llm.common import id_remainder, shared_folder, ship_package
from annospark.llm.queries import HELD_OUT, _tokenizer


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what language ID rejects: null texts, texts without letters, and narrow margins between languages; of equal sizes the first language counts.

    Each row is judged by its text alone, so repeated rows stay or go alike, and null ids stay. Without any labelled row there is no
    language, and all rows go; an empty table gives an empty table.
    """
    ship_package(spark)
    profiles = langid.learn_profiles(docs.where(id_remainder() != HELD_OUT))
    # Other columns travel as one, so that none clashes with those that are added.
    rows = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), "text")
    kept = langid.identify(rows, profiles).where(~F.col("rejected"))
    return kept.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near-duplicates (five words, 0.8), one row of an id and text.

    Documents are told by id and text: null ids stay, in a group with known ids they are last, and different texts of one id are
    documents of their own. Null, empty and wordless texts are near to nothing and stay. An empty table gives an empty table.
    """
    ship_package(spark)
    key = lambda text_hash: {"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "_none": F.col("doc_id").isNull(), "_hash": text_hash}
    found = minhash.linked(docs, percent=80, size=5, null_ids=True)
    own = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_hash") == F.col("head.text_hash"))
    kept = found.where(own).withColumns(key(F.col("text_hash"))).select("_id", "_none", "_hash").distinct()
    rows = docs.withColumns(key(F.xxhash64("text"))).join(kept, ["_id", "_none", "_hash"], "left_semi")
    return rows.dropDuplicates(["_id", "_none", "_hash"]).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten successive words of a benchmark item, or all of a shorter one.

    Documents are told by id and text, null ids too: repeated rows stay or go alike, and of different texts of one id only those that hold
    such words go. Null and empty texts hold none and stay, items without words are held by none; without items all rows stay, and an
    empty table gives an empty table.
    """
    ship_package(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hits = decontam.phrase_hits(docs, items).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it in whole; one that the mix takes in part counts from half its words on.

    Documents are told by id and text, null ids too. Rows that share both are repeated alike, as often as the mix takes the one it takes most.
    Null, empty and wordless texts come once for each whole epoch of their source, and go where that has no words at all. A null source is one of
    its own. An empty table gives an empty table.
    """
    weights = mixing.quality_weight(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("_hash"), "source", mixing.word_count().alias("size")).join(weights, "doc_id", "left")
    taken = mixing.mix(rows, weights=(3, 1, 2), share=1.5, max_epochs=2, size=F.col("size"), quality=F.col("quality_weight"), row_key=["_hash"])
    times = (F.col("epochs") + F.when((F.col("size") > 0) & (2 * F.col("part") >= F.col("size")), 1).otherwise(0)).cast("int")
    times = taken.groupBy(F.col("doc_id").alias("_id"), "_hash").agg(F.max(times).alias("_times")).where("_times > 0")
    repeated = docs.join(times, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return repeated.select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token ids and returns, read from the files, where each document's are and their crc32.

    A row for each row of docs, in ascending doc_id, null ids first; rows of one id are in the order of their texts' hashes, repeated rows are written
    each. Null and empty texts have the end id only; an empty table gives an empty table.
    """
    ship_package(spark)
    token_output.write_ids(docs, path := shared_folder(spark, "token-ids"), _tokenizer(), end_id=0)
    return token_output.read_ids(spark, path)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("mixed", mixed),
    ("token_ids", token_ids),
]

#: Compression, signatures and a tokenizer are beyond SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(path := shared_folder(spark, f"pipeline-{name}"))
        docs = spark.read.parquet(path)
    return docs
