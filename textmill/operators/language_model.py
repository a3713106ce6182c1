"""A trained language detector: smoothed likelihoods of character trigrams, by joins and sums only.

Trigrams are counted by language over all training texts; the commonest of each become
the model, a table of bounded size with a column of log-probabilities a language.
Detecting joins a text's trigrams with that table and adds them up; what the model
doesn't have counts as rare in every language.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions.text import col

#: Fixed value: shorter texts are unknown.
LEAST_CHARS = 50


def trigrams(text: str | Column) -> Column:
    """The trigrams of a text: letters in lower case, a blank for each run of others, one at each end."""
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(col(text)), r"[^\p{L}\p{M}]+", " ")), F.lit(" "))
    one = F.split(plain, "")

    def part(k: int) -> Column:
        return F.slice(one, F.lit(k), F.length(plain) - 2)

    # Three arrays side by side: a lambda that looked into one of them would split the text for each letter.
    return F.when(F.length(plain) > 2, F.zip_with(part(1), F.zip_with(part(2), part(3), lambda b, c: F.concat(b, c)), lambda a, bc: F.concat(a, bc)))


@dataclass
class LanguageModel:
    """languages, log-probabilities of trigrams (gram, p: an array in their order), and of those it doesn't have."""

    languages: list[str]
    grams: DataFrame
    rare: list[float]

    def detect(self, texts: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
        """(id, language, confidence) of each row: the likeliest language and its share of all languages' likelihoods.

        Texts of fewer than LEAST_CHARS characters or without a letter are unknown, with
        0, as all are without a trained language; rows need different ids. Ties go to
        the first name.
        """
        rows = texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        if not self.languages:
            return rows.select(F.col("id").alias(id_col), F.lit("unknown").alias("language"), F.lit(0.0).alias("confidence"))
        long = rows.where((F.length("text") >= LEAST_CHARS) & F.col("text").rlike(r"\p{L}"))
        each = long.select("id", F.explode(trigrams("text")).alias("gram"))
        rare = F.array(*[F.lit(x) for x in self.rare])
        known = each.join(F.broadcast(self.grams), "gram", "left").withColumn("p", F.coalesce("p", rare))  # per_language rows a language
        sums = known.groupBy("id").agg(*[F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(len(self.languages))])
        best = F.greatest(*[F.col(f"s{i}") for i in range(len(self.languages))]) if len(self.languages) > 1 else F.col("s0")
        name = F.coalesce(*[F.when(F.col(f"s{i}") == best, F.lit(x)) for i, x in enumerate(self.languages)])
        total = sum((F.exp(F.col(f"s{i}") - best) for i in range(len(self.languages))), F.lit(0.0))
        told = sums.select("id", name.alias("language"), (1 / total).alias("confidence"))
        out = rows.select("id").join(told, "id", "left")
        return out.select(F.col("id").alias(id_col), F.coalesce("language", F.lit("unknown")).alias("language"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))


def train(texts: DataFrame, lang_col: str = "language", text_col: str = "text", per_language: int = 3000, smoothing: float = 0.5) -> LanguageModel:
    """A model of all texts with a language; its grams are the per_language commonest of each, those of equal counts by themselves."""
    rows = texts.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = rows.select(F.col(lang_col).alias("language"), F.explode(trigrams(text_col)).alias("gram")).groupBy("language", "gram").agg(F.count(F.lit(1)).alias("n"))
    of = W.partitionBy("language")
    ranked = counts.withColumn("total", F.sum("n").over(of)).withColumn("rank", F.row_number().over(of.orderBy(F.desc("n"), "gram")))
    top = [r.asDict() for r in ranked.where(F.col("rank") <= per_language).select("language", "gram", "n", "total").collect()]  # per_language a language
    languages = sorted({r["language"] for r in top})
    place = {x: i for i, x in enumerate(languages)}
    names = sorted({r["gram"] for r in top})
    total = {r["language"]: r["total"] for r in top}
    from math import log

    room = smoothing * (len(names) + 1)
    rare = [log(smoothing / (total[x] + room)) for x in languages]
    table = {g: list(rare) for g in names}
    for r in top:
        table[r["gram"]][place[r["language"]]] = log((r["n"] + smoothing) / (total[r["language"]] + room))
    return LanguageModel(languages, texts.sparkSession.createDataFrame(list(table.items()), "gram string, p array<double>"), rare)
