"""The corpus model over the driver's tables: the same expressions for Spark and for an oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.schemas import TOPICS, TYPES

_TYPE_CASE = " ".join(f"WHEN doc_id % 11 = {i} THEN '{t}'" for i, t in enumerate(TYPES))
_TOPIC_CASE = " ".join(f"WHEN doc_id % 9 = {i} THEN '{t}'" for i, t in enumerate(TOPICS))

#: Columns in SQL that both engines read alike; what stands before each is its name.
_COLUMNS = {
    "id": "{sha}(text)",
    "doc_id": "doc_id",
    "source_url": "concat('https://', source, '.example.org:8080/files/doc%20', doc_id, '.docx?v=1')",
    "crawl_id": "concat('CRAWL-2025-0', doc_id % 3 + 1)",
    "original_filename": "CASE WHEN doc_id % 29 = 0 THEN '' WHEN doc_id % 31 = 0 THEN NULL ELSE concat('doc ', doc_id, '.docx') END",
    "file_size_bytes": "cast(n_chars * 3 as bigint)",
    "status": "CASE WHEN doc_id % 37 = 0 THEN 'failed' WHEN doc_id % 23 = 0 THEN 'duplicate' ELSE 'uploaded' END",
    "uploaded_day": "CASE WHEN doc_id % 47 = 0 THEN NULL ELSE cast(doc_id % 101 as int) END",
    "extracted_at": "CASE WHEN doc_id % 7 = 0 THEN NULL ELSE cast(doc_id % 97 as int) END",
    "extraction_error": "CASE WHEN doc_id % 43 = 0 THEN 'timeout' END",
    "language": "CASE WHEN doc_id % 50 = 0 THEN NULL WHEN doc_id % 41 = 0 THEN 'unknown' ELSE lang END",
    "char_count": "cast(n_chars as int)",
    "word_count": "cast({words} as int)",
    "embedded_at": "CASE WHEN doc_id % 3 = 0 THEN cast(doc_id % 89 as int) END",
    "embedding_model": "CASE WHEN doc_id % 3 = 0 THEN CASE WHEN doc_id % 5 = 0 THEN 'skipped:too_long' WHEN doc_id % 4 = 0 THEN NULL ELSE 'model-a' END END",
    "classified_at": "CASE WHEN doc_id % 6 = 0 THEN cast(doc_id % 83 as int) END",
    "cluster_id": "CASE WHEN doc_id % 6 = 0 THEN cast(doc_id % 13 as int) END",
    "document_type": f"CASE {_TYPE_CASE} END",
    "document_topic": f"CASE {_TOPIC_CASE} END",
    "classification_confidence": "CASE WHEN doc_id % 53 = 0 THEN NULL ELSE cast((doc_id * 7919) % 1000 as double) / 1000 END",
    "classification_model": "CASE WHEN doc_id % 11 = 10 THEN NULL WHEN doc_id % 2 = 0 THEN 'base-v1' ELSE 'base-v2' END",
}
#: Words by ASCII blanks, which the driver's texts are parted by.
_SPARK = {"sha": "_sha", "words": r"size(filter(split(text, '[ \\t\\n\\r\\f]+'), x -> x <> ''))"}
_DUCK = {"sha": "sha256", "words": r"len(list_filter(regexp_split_to_array(text, '[ \t\n\r\f]+'), lambda x: x <> ''))"}


def _spark_sql(name: str) -> str:
    return _COLUMNS[name].replace("{sha}(text)", "sha2(text, 256)").replace("{words}", _SPARK["words"])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus table; only the columns that a query uses are computed and read."""
    raw = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return raw.select(*[F.expr(_spark_sql(name)).alias(name) for name in _COLUMNS], "text")


def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side table, one row for each labelled document: (raw_id, corrected_id, status)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return labels.selectExpr(
        "cast(doc_id as string) AS raw_id",
        "CASE WHEN quality = 1 THEN concat('c', cast(doc_id % 50 as string)) END AS corrected_id",
        "CASE WHEN quality = 1 THEN 'corrected' WHEN toxic = 1 THEN 'error' ELSE 'skipped' END AS status",
    )


def _duck() -> str:
    columns = ", ".join(f"{sql.replace('{sha}', 'sha256').replace('{words}', _DUCK['words'])} AS {name}" for name, sql in _COLUMNS.items())
    return f"SELECT {columns}, text FROM documents"


#: The same in DuckDB, as the heads of oracle queries.
CORPUS_SQL = f"corpus AS ({_duck()})"
CORRECTIONS_SQL = """corrections AS (
  SELECT cast(doc_id as varchar) AS raw_id, CASE WHEN quality = 1 THEN concat('c', cast(doc_id % 50 as varchar)) END AS corrected_id,
         CASE WHEN quality = 1 THEN 'corrected' WHEN toxic = 1 THEN 'error' ELSE 'skipped' END AS status FROM labels)"""


def oracle(body: str) -> str:
    """An oracle query over corpus and corrections."""
    return f"WITH {CORPUS_SQL}, {CORRECTIONS_SQL} {body}"
