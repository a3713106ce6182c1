"""From index lines to documents: filter, parse, validate, identify and store, as one batch plan.

Fetching is behind a function (sources.archive); everything else is joins and
projections. First-wins is decided by input order, then URL, so a batch gives the
same rows however it is partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions import records as R
from textmill.functions import text as T
from textmill.operators import predicates as P
from textmill.sources.store import written

#: Fixed value: the media type that the index is filtered by.
DOCX_MIME = "application/vnd.openxmlformats-officedocument.wordprocessingml.document"


def index_records(lines: DataFrame, mime: str = DOCX_MIME, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The JSON parts (and the columns to keep) of index lines that name the media type and have status '200'; others are dropped.

    The cheap substring test stands first and stays there: only its survivors are parsed.
    """
    x = F.col(column)
    at = F.locate("{", x)
    json = F.substring(x, at, F.length(x))
    return lines.where(x.contains(mime)).where(at > 0).where(F.get_json_object(json, "$.status") == "200").select(json.alias(column), *keep)


def pointers(records: DataFrame) -> DataFrame:
    """Index records with their byte range as numbers (null where they aren't)."""
    return records.withColumn("range_start", F.col("offset").try_cast("bigint")).withColumn(
        "range_length", F.col("length").try_cast("bigint")
    )


def unseen(records: DataFrame, documents: DataFrame, force: bool = False, retry_failed: bool = False) -> DataFrame:
    """Records whose URL no document has; with retry_failed, failed ones count as unseen. Each URL once."""
    once = records.dropDuplicates(["url"])
    if force:
        return once
    known = documents.where(P.is_status("uploaded", "duplicate")) if retry_failed else documents
    return once.join(known.select(T.url_key("source_url").alias("_key")), T.url_key("url") == F.col("_key"), "left_anti")


def cross_crawl_duplicates(records: DataFrame, documents: DataFrame, crawl_id: str, now: Column) -> DataFrame:
    """A duplicate row for each URL that is known, but not in this crawl."""
    tracked = documents.where(F.col("crawl_id") == crawl_id).select(F.col("source_url").alias("url"))
    known = documents.select(F.col("source_url").alias("url"))
    fresh = records.select("url").distinct().join(known, "url", "left_semi").join(tracked, "url", "left_anti")
    return fresh.select(
        T.duplicate_id("url", F.lit(crawl_id)).alias("id"),
        F.col("url").alias("source_url"),
        F.lit(crawl_id).alias("crawl_id"),
        F.lit("duplicate").alias("status"),
        F.lit("cross-crawl duplicate").alias("error_message"),
        now.alias("discovered_at"),
    )


def identified(fetched: DataFrame, documents: DataFrame, crawl_id: str, now: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Document rows of fetched records (url, content, error, position), and columns of these to keep.

    A fetch error gives a failed row named by its URL, invalid content one named by
    its hash; content that another URL has, in the table or earlier in the batch,
    gives a duplicate; the rest is stored. Positions are unique.
    """
    # Narrow before anything is shuffled; what failed has no hash, and its URL for a key instead.
    rows = fetched.select(
        "url", "position", F.when(F.col("content").isNull(), F.coalesce("error", F.lit("no content"))).otherwise(F.col("error")).alias("error"),
        R.validate_docx("content").alias("check"), T.content_id("content").alias("hash"), F.octet_length("content").cast("bigint").alias("size"),
    )
    owners = documents.where(P.is_status("uploaded")).select(F.col("id").alias("hash"), F.col("source_url").alias("owner")).dropDuplicates(["hash"])
    # Without the contents, written: they are read for their hashes once. A content that a third of
    # all rows have is a row a task before it is shuffled, and its rows' join can be split.
    rows = written(rows.withColumn("_key", F.coalesce("hash", "url")))
    firsts = rows.groupBy("_key").agg(F.min(F.struct("position", "url")).alias("_first"))
    rows = rows.join(owners.hint("merge"), "hash", "left").join(firsts.hint("merge"), "_key")
    rows = rows.withColumn("_owner", F.coalesce("owner", F.col("_first.url")))
    failed, invalid = F.col("error").isNotNull(), ~F.col("check.is_valid")
    duplicate = (F.col("_owner") != F.col("url")) | ~F.col("position").eqNullSafe(F.col("_first.position"))
    status = F.when(failed | invalid, "failed").when(duplicate, "duplicate").otherwise("uploaded")
    return rows.select(
        *keep,
        F.when(failed, T.failed_id("url"))
        .when(invalid, F.col("hash"))
        .when(duplicate, T.duplicate_id("url", F.lit(crawl_id)))
        .otherwise(F.col("hash"))
        .alias("id"),
        F.col("url").alias("source_url"),
        F.lit(crawl_id).alias("crawl_id"),
        T.filename_from_url("url").alias("original_filename"),
        F.when(~failed, F.col("size")).alias("file_size_bytes"),
        status.alias("status"),
        F.when(failed, F.col("error"))
        .when(invalid, F.col("check.error"))
        .when(duplicate, F.concat(F.lit("duplicate content of "), F.col("hash")))
        .alias("error_message"),
        F.when(~failed, ~invalid).alias("is_valid_docx"),
        now.alias("discovered_at"),
        F.when(~failed, now).alias("downloaded_at"),
        F.when(status == "uploaded", now).alias("uploaded_at"),
    )


def refetched(documents: DataFrame, stored: DataFrame, crawl_id: str) -> DataFrame:
    """documents without this crawl's failed rows of URLs that have now been fetched."""
    done = stored.where(~F.col("id").startswith("failed-")).select(T.failed_id("source_url").alias("id")).distinct()
    return documents.join(done.withColumn("crawl_id", F.lit(crawl_id)), ["id", "crawl_id"], "left_anti")


def first_holders(rows: DataFrame, hash_col: str, order: list[str]) -> DataFrame:
    """rows with holder_rank: 1 for the first row of each content."""
    return rows.withColumn("holder_rank", F.row_number().over(W.partitionBy(hash_col).orderBy(*order)))


def uncorrected(documents: DataFrame, corrections: DataFrame) -> DataFrame:
    """Uploaded documents that have not been inspected, by id."""
    return documents.where(P.is_status("uploaded")).join(corrections.select(F.col("raw_id").alias("id")), "id", "left_anti").orderBy("id")


def to_inspect_again(documents: DataFrame, corrections: DataFrame) -> DataFrame:
    """Uploaded documents not inspected, or with an error."""
    settled = corrections.where(~F.col("status").eqNullSafe("error")).select(F.col("raw_id").alias("id"))
    return documents.where(P.is_status("uploaded")).join(settled, "id", "left_anti").orderBy("id")


def missing_crawls(catalog: DataFrame, filtered: DataFrame) -> DataFrame:
    """Crawls of the catalog (id, position) that have no filtered index, in the catalog's order."""
    return catalog.join(filtered.select("id").distinct(), "id", "left_anti").orderBy("position")


def newest_crawls(catalog: DataFrame, n: int) -> DataFrame:
    if n < 1:
        raise ValueError("n is at least 1")
    return catalog.orderBy("position").limit(n)


def corrections_of(objects: DataFrame) -> DataFrame:
    """Correction rows, with the corrected bytes, of raw objects (raw_id, content, error)."""
    rows = objects.withColumn("repair", R.repaired("content")).withColumn("outcome", T.correction_outcome("repair.status"))
    bad = F.col("error").isNotNull() | F.col("content").isNull()
    fixed = F.when(~bad, F.col("repair.candidate"))
    return rows.select(
        "raw_id",
        F.when(fixed.isNotNull(), T.content_id(fixed)).alias("corrected_id"),
        F.when(bad, "error").otherwise(F.col("outcome.status")).alias("status"),
        F.when(bad, F.coalesce("error", F.lit("object not found"))).otherwise(F.col("outcome.reason")).alias("reason"),
        F.octet_length("content").cast("bigint").alias("raw_file_size_bytes"),
        F.octet_length(fixed).cast("bigint").alias("corrected_file_size_bytes"),
        F.when(fixed.isNotNull(), "trailing_crlf").alias("correction_type"),
        fixed.alias("content"),
    )
