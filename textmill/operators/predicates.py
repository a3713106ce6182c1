"""Filters: the state of a document as predicates, and conjunctions built from facets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.plain import least_confidence


def is_status(*status: str) -> Column:
    return F.col("status").isin(*status)


def _uploaded() -> Column:
    return F.col("status") == "uploaded"


def extract_selectable() -> Column:
    """Work for the extractor: errored rows are not tried again."""
    return _uploaded() & F.col("extracted_at").isNull() & F.col("extraction_error").isNull()


def extract_pending() -> Column:
    """What is reported as pending; it includes errored rows."""
    return _uploaded() & F.col("extracted_at").isNull()


def extracted() -> Column:
    return F.col("extracted_at").isNotNull() & F.col("extraction_error").isNull()


def extract_error() -> Column:
    return F.col("extraction_error").isNotNull()


def embed_selectable() -> Column:
    return extracted() & F.col("embedded_at").isNull()


def embed_skipped() -> Column:
    return F.col("embedding_model").like("skipped:%")


def embedded() -> Column:
    """Reported as embedded; a null model is not counted."""
    return F.col("embedded_at").isNotNull() & ~F.col("embedding_model").like("skipped:%")


def cluster_selectable() -> Column:
    return F.col("embedded_at").isNotNull() & F.col("classified_at").isNull()


def label_pending() -> Column:
    """What is reported as waiting for a label."""
    return extracted() & F.col("document_type").isNull()


def label_selectable() -> Column:
    """Work for the classifier."""
    return extracted() & (F.col("word_count") > 0) & F.col("classification_model").isNull()


def classified() -> Column:
    return F.col("document_type").isNotNull()


def conjunction(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def facet_filter(
    type: str = "", topic: str = "", lang: str = "", min_confidence: str | float | None = None, exclude: str | None = None,
    confidence_col: str = "classification_confidence",
) -> Column:
    """Classified rows with the given facets; ``exclude`` leaves one dimension out, for that dimension's own counts."""
    parts = [classified()]
    for name, column, value in (("type", "document_type", type), ("topic", "document_topic", topic), ("lang", "language", lang)):
        if value and name != exclude:
            parts.append(F.col(column) == value)
    if (least := least_confidence(min_confidence)) is not None:
        parts.append(F.col(confidence_col) >= least)
    return conjunction(parts)


def id_range(start: str, end: str, id_col: str = "id") -> Column:
    """start <= id < end, as strings; both bounds reach the scan."""
    return (F.col(id_col) >= start) & (F.col(id_col) < end)


def confident_labels(labels: DataFrame, least: float) -> DataFrame:
    """Labels of at least this confidence; none counts as 0."""
    return labels.where(F.coalesce("confidence", F.lit(0.0)) >= least)


def find(documents: DataFrame, column: str, value: str) -> DataFrame:
    """The first document with a value; of several, the one with the smallest id."""
    return documents.where(F.col(column) == value).orderBy("id").limit(1)


def urls(documents: DataFrame, *status: str, crawl_id: str | None = None) -> DataFrame:
    """The distinct URLs of some states, or of a crawl."""
    rows = documents.where(is_status(*status)) if status else documents
    rows = rows.where(F.col("crawl_id") == crawl_id) if crawl_id is not None else rows
    return rows.select("source_url").distinct()
