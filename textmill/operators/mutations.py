"""Changes to tables as pure functions: an old version and some changes give the new version.

Parquet has no row-level updates, so a new version is written beside the old one
and swapped in (sources.store.replace_table). Every function expects one change
per key, unless it says otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def upsert(old: DataFrame, changes: DataFrame, key: str = "id", columns: list[str] | None = None) -> DataFrame:
    """Insert or update by key; only ``columns`` (default: those the changes have) are written.

    A column that is written takes the change's value, null included; others keep theirs.
    """
    return _changed(old, changes, key, columns, "full")


def _changed(old: DataFrame, changes: DataFrame, key: str, columns: list[str] | None, how: str) -> DataFrame:
    written = [c for c in (columns or changes.columns) if c != key]
    new = changes.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in written], F.lit(True).alias("_changed"))
    joined = old.join(new, old[key] == new["_key"], how)
    return joined.select(
        *[
            F.coalesce(F.col(c), F.col("_key")).alias(c)
            if c == key
            else (F.when(F.col("_changed"), F.col(f"_new_{c}")).otherwise(F.col(c)).cast(old.schema[c].dataType).alias(c) if c in written else F.col(c))
            for c in old.columns
        ]
    )


def update(old: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """As upsert, but keys that the table doesn't have are not inserted."""
    return _changed(old, changes, key, None, "left")


def insert_ignore(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Append the rows whose key is new; of several with one key, one."""
    fresh = new.dropDuplicates([key]).join(old.select(key), key, "left_anti")
    return old.unionByName(fresh, allowMissingColumns=True)


def latest_per_key(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Of all rows of a key, the newest; the new table's wins a tie."""
    rows = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)), allowMissingColumns=True)
    w = W.partitionBy(key).orderBy(F.desc_nulls_last(order), F.desc("_age"))
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank", "_age")


def upsert_corrections(old: DataFrame, inspected: DataFrame, now: Column) -> DataFrame:
    """All columns are overwritten; corrected_at is set for corrected rows only."""
    new = inspected.withColumn("inspected_at", now).withColumn(
        "corrected_at", F.when(F.col("status") == "corrected", now).cast("timestamp")
    )
    return upsert(old, new, "raw_id", [c for c in old.columns if c != "raw_id"])


def delete(old: DataFrame, ids: DataFrame, key: str = "id", crawl_id: str | None = None) -> DataFrame:
    """Without some ids; with a crawl, only that crawl's rows go."""
    doomed = ids.select(key).withColumn("_crawl", F.lit(crawl_id).cast("string"))
    match = (old[key] == doomed[key]) & (doomed["_crawl"].isNull() | (old["crawl_id"] == doomed["_crawl"]) if crawl_id else F.lit(True))
    return old.join(doomed, match, "left_anti")


def set_extraction(old: DataFrame, done: DataFrame, now: Column) -> DataFrame:
    """Measures and time of extracted documents, whose error is cleared; of failed ones only the error.

    done has id, word_count, char_count, table_count, image_count, language, language_confidence, error.
    """
    measures = ("word_count", "char_count", "table_count", "image_count", "language", "language_confidence")
    good = F.col("_seen") & F.col("_error").isNull()
    new = done.select(
        F.col("id").alias("_id"), F.lit(True).alias("_seen"), F.col("error").alias("_error"), *[F.col(c).alias(f"_{c}") for c in measures]
    )
    joined = old.join(new, old["id"] == new["_id"], "left")

    def value(c: str) -> Column:
        if c in measures:
            return F.when(good, F.col(f"_{c}")).otherwise(F.col(c)).cast(old.schema[c].dataType).alias(c)
        if c == "extracted_at":
            return F.when(good, now).otherwise(F.col(c)).alias(c)
        if c == "extraction_error":
            return F.when(F.col("_seen"), F.col("_error")).otherwise(F.col(c)).alias(c)
        return F.col(c)

    return joined.select(*[value(c) for c in old.columns])


def set_embeddings(old: DataFrame, vectors: DataFrame, model: str, now: Column) -> DataFrame:
    """Vector, model and time of some ids (id, vector)."""
    new = vectors.select("id", F.col("vector").cast("array<float>").alias("embedding"), F.lit(model).alias("embedding_model"), now.alias("embedded_at"))
    return update(old, new)


def set_skipped(old: DataFrame, skipped: DataFrame, now: Column) -> DataFrame:
    """Time and 'skipped:reason' of some ids (id, reason); their vectors stay."""
    new = skipped.select("id", F.concat(F.lit("skipped:"), F.col("reason")).alias("embedding_model"), now.alias("embedded_at"))
    return update(old, new)


def set_clusters(old: DataFrame, clusters: DataFrame, now: Column) -> DataFrame:
    """Cluster, label (empty: null) and one time for all of some ids (id, cluster_id, cluster_label)."""
    new = clusters.select("id", "cluster_id", F.nullif("cluster_label", F.lit("")).alias("cluster_label"), now.alias("classified_at"))
    return update(old, new)


def set_labels(old: DataFrame, labels: DataFrame, model: str) -> DataFrame:
    """Type, topic, confidence and model of some ids."""
    new = labels.select(
        "id", "document_type", "document_topic",
        F.col("confidence").cast("float").alias("classification_confidence"), F.lit(model).alias("classification_model"),
    )
    return update(old, new)


def set_one_label(old: DataFrame, ids: DataFrame, document_type: str, document_topic: str, confidence: float, model: str) -> DataFrame:
    """One label for many ids."""
    new = ids.select("id", F.lit(document_type).alias("document_type"), F.lit(document_topic).alias("document_topic"), F.lit(confidence).alias("confidence"))
    return set_labels(old, new, model)


def rename(old: DataFrame, column: str, names: Mapping[str, str]) -> DataFrame:
    """Values replaced by a map; others stay."""
    return old.replace(dict(names), subset=[column])


def rename_counts(old: DataFrame, column: str, names: Mapping[str, str]) -> DataFrame:
    """(old_name, n): what rename would change."""
    return old.where(F.col(column).isin(list(names))).groupBy(F.col(column).alias("old_name")).agg(F.count(F.lit(1)).alias("n"))


def merge_dictionaries(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All keys of both; the new row wins."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)
