"""From raw documents to packed sequences, in five stages.

Language ID rejects documents without a language; the n-gram Jaccard join (five
words, similarity 0.8) keeps the smallest id of every group of near copies;
personal data is masked; sources are mixed to their target weights, so a
document may come several times or in part; packing cuts what is left into
sequences. Documents without any word are in no group and stay as they are.

Defined cases: NULL, empty and letterless texts go in the first stage; NULL lang and source
stay and count as a source of their own; NULL ids come last in ties; repeated rows of one id
and text stay once; very long texts are read whole in every stage; extra columns pass all
stages but the last; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join, language_id, mixing, packing, pii
from tidemark.llm.shared import table
from tidemark.session import scratch_path

#: Names a document within the copy stage.
ROW = "__row"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are NULL, empty or without a letter; the model is fitted on ``docs``."""
    columns = docs.columns
    model = language_id.fit(docs.select("doc_id", "text", "lang"))
    judged = language_id.identify(docs.select(F.struct(*[F.col(c) for c in columns]).alias("row"), "text"), model)
    kept = judged.where(F.col("lang_pred") != language_id.UNKNOWN)
    return kept.select(*[F.col("row")[c].alias(c) for c in columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: the one with the smallest id, NULL last, then by a hash.

    A document is its id and text: different texts of one id are judged apart, rows without
    an id are searched for copies as well, and repeated rows of one id and text stay once.
    """
    keyed = docs.withColumn(ROW, F.xxhash64("doc_id", "text"))
    found = jaccard_join.join(keyed, id_col=ROW).withColumnRenamed("doc_id", ROW)
    ranked = keyed.select(ROW, "doc_id").join(found, ROW)
    first = F.min_by(ROW, F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias(ROW)
    kept = ranked.where(F.col("n_shingles") > 0).groupBy("component_id").agg(first).select(ROW)
    wordless = found.where(F.col("n_shingles") == 0).select(ROW)
    once = keyed.join(kept.unionByName(wordless), ROW, "left_semi").dropDuplicates([ROW])
    return once.select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the name of its kind and counts the characters anew."""
    return docs.withColumn("text", pii.redact(F.col("text"))).withColumn(
        "n_chars", F.char_length("text").cast("bigint")
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats, cuts and drops documents so that sources meet their targets."""
    mixed = mixing.repeated(docs, quality=mixing.text_quality(F.col("text")))
    return mixed.withColumn("n_chars", F.char_length("text").cast("bigint"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return packing.report(docs)


STAGES = [
    ("language_id", detect_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("pii", mask_personal_data),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "corpus")
    for name, function in STAGES:
        path = f"{folder}/{name}"
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
