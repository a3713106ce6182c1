"""Pages, work queues, listings, manifests and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions.plain import page_bounds
from textmill.functions.text import document_url, label_of
from textmill.operators import predicates as P
from textmill.schemas import LANGUAGE_NAMES, TOPIC_LABELS, TYPE_LABELS

CONFIDENCE = "classification_confidence"
MANIFEST_CAP = 2_000_000


def page_rows(documents: DataFrame) -> DataFrame:
    return documents.select(
        "id",
        F.col("original_filename").alias("filename"),
        F.col("document_type").alias("type"),
        F.col("document_topic").alias("topic"),
        "language",
        "word_count",
        F.col(CONFIDENCE).alias("confidence"),
    )


def page(documents: DataFrame, page: str | int = 1, limit: str | int = 25, order_id: str = "id", **chosen) -> DataFrame:
    """One page of a faceted search: the surest first, unknown confidence last, ids breaking ties.

    Columns are cut before the order is found, so a top-k keeps narrow rows.
    """
    _, n, offset = page_bounds(page, limit)
    found = documents.where(P.facet_filter(**chosen))
    return found.orderBy(F.desc_nulls_last(CONFIDENCE), order_id).offset(offset).limit(n)


def with_labels(rows: DataFrame) -> DataFrame:
    return (
        rows.withColumn("type_label", label_of("type", TYPE_LABELS))
        .withColumn("topic_label", label_of("topic", TOPIC_LABELS))
        .withColumn("language_name", label_of("language", LANGUAGE_NAMES))
    )


def total(documents: DataFrame, limit: int = 25, **chosen) -> DataFrame:
    """(total, pages) of a search."""
    n = documents.where(P.facet_filter(**chosen)).agg(F.count(F.lit(1)).alias("total"))
    return n.withColumn("pages", F.ceil(F.col("total") / limit))


def samples(documents: DataFrame, column: str, value: str, n: int = 5) -> DataFrame:
    """The surest documents of a facet."""
    rows = documents.where(F.col(column) == value)
    return rows.orderBy(F.desc_nulls_last(CONFIDENCE), "id").limit(n)


def work_queue(documents: DataFrame, state, since: str, n: int) -> DataFrame:
    """The n oldest rows of a state, rows without a time last."""
    return documents.where(state).orderBy(F.asc_nulls_last(since), "id").limit(n)


def latest(documents: DataFrame, state, since: str, n: int | None = None) -> DataFrame:
    """Rows of a state, newest first."""
    rows = documents.where(state).orderBy(F.desc(since), "id")
    return rows.limit(n) if n else rows


def listing(documents: DataFrame, n: int, *status: str) -> DataFrame:
    """Any n documents, of some states; the smallest ids, to be reproducible."""
    rows = documents.where(P.is_status(*status)) if status else documents
    return rows.orderBy("id").limit(n)


def random_order(rows: DataFrame, id_col: str = "id", seed: int = 42) -> DataFrame:
    """A reproducible random order, by a hash of id and seed."""
    return rows.orderBy(F.xxhash64(F.col(id_col), F.lit(seed)), id_col)


def top_and_rest(counts: DataFrame, key: str, n: int, rest: str = "other") -> DataFrame:
    """The n largest counts, and the sum of all others in one row."""
    rank = F.row_number().over(W.partitionBy().orderBy(F.desc("n"), key))
    named = counts.withColumn("_rank", rank).select(F.when(F.col("_rank") <= n, F.col(key)).otherwise(rest).alias(key), "n")
    return named.groupBy(key).agg(F.sum("n").alias("n"))


def manifest_urls(documents: DataFrame, base: str, cap: int = MANIFEST_CAP, **chosen) -> DataFrame:
    """The URLs of a search's documents, in the order of their ids."""
    rows = documents.where(P.facet_filter(**chosen)).select("id").orderBy("id").limit(cap)
    return rows.select(document_url("id", base).alias("url"))


def manifest_ids(documents: DataFrame) -> DataFrame:
    """The ids of uploaded documents, in order."""
    return documents.where(P.is_status("uploaded")).select("id").orderBy("id")


def export_rows(documents: DataFrame, base: str) -> DataFrame:
    """The published columns of classified documents."""
    return documents.where(P.classified()).select(
        "id",
        F.coalesce(F.nullif("original_filename", F.lit("")), F.lit("unknown.docx")).alias("filename"),
        F.col("document_type").alias("type"),
        F.col("document_topic").alias("topic"),
        "language",
        "word_count",
        F.col(CONFIDENCE).cast("float").alias("confidence"),
        document_url("id", base).alias("url"),
    )
