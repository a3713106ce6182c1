"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again as the next one's docs. All but the last return the columns of
documents. A document whose whole text a stage has removed is gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import bpe, crf, line_dedup, near_dedup, packing, suffix_dedup
from textmill.llm.common import Scratch, table


def _session(spark: SparkSession) -> None:
    """A stage's shuffle files go when its result has been written, not when the driver collects its garbage."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents with a lower quality score go.
LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-level conditional random field holds for good.

    It is fitted on the labelled documents that are not held out. Empty and null
    texts are one empty line and get its score; null ids and repeated rows are
    judged one by one, so equal texts share a verdict. Without both labels all
    documents get the same score; no documents give none.
    """
    _session(spark)
    model = crf.fit(*crf.learning_rows(docs, table(spark, sf_dir, "labels")))
    kept = crf.score_documents(docs.select(*COLUMNS), model, carry=tuple(COLUMNS[1:]))
    return kept.where(F.col("score") >= LEAST_QUALITY).select(*COLUMNS)


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that they share with an earlier one; emptied ones go.

    Null and empty texts have nothing to lose and stay. A null id is earlier than any
    other; rows that repeat id and text are one document and all stay; of rows with
    one id and different texts those with the smaller text hash are earlier. No
    documents give none.
    """
    _session(spark)
    out = line_dedup.line_dedup(docs.select(*COLUMNS), counts=True)
    return _with_length(out.where((F.col("n_removed") == 0) | (F.trim("text") != "")))


def _key(docs: DataFrame):
    """What tells rows apart, nulls and repeated ids included."""
    return docs["doc_id"], F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near-duplicates.

    Rows that repeat id and text stay once. Null and empty texts are linked with
    nothing and stay; a null id stays only if its group has no other. No documents
    give none.
    """
    _session(spark)
    kept = near_dedup.near_duplicates(docs.select("doc_id", "text")).where("kept")
    kept = Scratch(spark, "near-kept").write(kept.groupBy(F.col("doc_id").alias("id"), "text_hash").count())
    i, h = _key(docs)
    out = docs.join(kept.hint("merge"), i.eqNullSafe(kept["id"]) & (h == kept["text_hash"]), "left_semi").select(*COLUMNS)
    return out if kept.where("count > 1").isEmpty() else out.dropDuplicates(["doc_id", "text"])


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 50 bytes or more that an earlier one has; emptied ones go.

    A character that is cut into is dropped whole. Null and empty texts stay; a null id
    is smaller than any other; rows of one id aren't removed for another. No documents
    give none.
    """
    _session(spark)
    found = suffix_dedup.dedup_bytes(docs.select("doc_id", "text"), with_text=True).where("n_removed > 0")
    found = found.select(F.col("doc_id").alias("id"), "text_hash", "kept_text").dropDuplicates(["id", "text_hash"])
    i, h = _key(docs)
    joined = docs.join(found.hint("merge"), i.eqNullSafe(found["id"]) & (h == found["text_hash"]), "left")
    left = joined.where(F.col("kept_text").isNull() | (F.trim("kept_text") != ""))
    return _with_length(left.withColumn("text", F.coalesce("kept_text", "text")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of documents, each with an end token, in sequences of the permitted lengths.

    A null or empty text is its end token; rows with a null id or that repeat others
    are packed like any; no documents give no pieces.
    """
    _session(spark)
    encoded = bpe.encode_documents(docs.select("doc_id", "text"), bpe.installed(), end=bpe.END)
    return packing.pack_documents(Scratch(spark, "tokens").write(encoded), ids="ids")


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near),
    ("suffix-array dedup", substrings),
    ("best-fit packing", packed),
]

#: The classifier, the alignment and the packing have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.write(docs)
    return docs
