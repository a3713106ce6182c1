"""Vectors as arrays of floats: weighted means, norms, cosine, approximate neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import col


def dot(a: str | Column, b: str | Column) -> Column:
    products = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: str | Column) -> Column:
    return F.sqrt(dot(a, a))


def normalised(a: str | Column) -> Column:
    """Of length 1, or as it is where the length is 0; beside a NaN all but 0 becomes NaN."""
    n = norm(a)
    return F.when(n > 0, F.transform(col(a), lambda x: F.when(x == 0, x.cast("double")).otherwise(x.cast("double") / n))).otherwise(
        F.transform(col(a), lambda x: x.cast("double"))
    )


def cosine(a: str | Column, b: str | Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def to_text(a: str | Column) -> Column:
    """A vector in its text form, [a,b,...]."""
    return F.concat(F.lit("["), F.array_join(F.transform(col(a), lambda x: x.cast("string")), ","), F.lit("]"))


def from_text(text: str | Column) -> Column:
    """A vector from its text form; null where that can't be read."""
    return F.from_json(col(text), "array<float>")


def document_vectors(chunks: DataFrame, id_col: str = "id", vector_col: str = "vector", weight_col: str = "weight") -> DataFrame:
    """(id, vector): the vector of an only chunk as it is; else the mean by weight, of length 1 if that isn't 0.

    Chunks are summed before the shuffle, one running vector a document and task, so
    no document's chunks are gathered in one row. Null vectors are left out.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    rows = chunks.where(F.col(vector_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(weight_col).cast("double").alias("w"), F.col(vector_col).cast("array<double>").alias("x")
    )
    mean = Summarizer.mean(array_to_vector("x"), F.col("w"))
    whole = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.first("x").alias("only"), mean.alias("mean"))
    vector = F.when(F.col("n") == 1, F.col("only")).otherwise(normalised(vector_to_array("mean")))
    return whole.select(F.col("id").alias(id_col), vector.alias("vector"))


def nearest(vectors: DataFrame, query: list[float], k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k rows with the largest cosine to a query, exactly: one scan and a top-k."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return vectors.select(id_col, cosine(vector_col, q).alias("cosine")).orderBy(F.desc_nulls_last("cosine"), id_col).limit(k)


def approximate_index(vectors: DataFrame, vector_col: str = "embedding", tables: int = 8, length: float = 0.5, seed: int = 42):
    """(model, hashed rows) of random-projection buckets over vectors of length 1."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    rows = vectors.withColumn("features", array_to_vector(normalised(vector_col)))
    model = BucketedRandomProjectionLSH(
        inputCol="features", outputCol="hashes", numHashTables=tables, bucketLength=length, seed=seed
    ).fit(rows)
    return model, model.transform(rows)
