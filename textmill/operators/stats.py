"""Aggregates: counts, shares, histograms, stage reports and evaluations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions.text import BELOW, HISTOGRAM, band
from textmill.operators import predicates as P
from textmill.operators.sampling import counted_places

CONFIDENCE = "classification_confidence"


def known_language() -> Column:
    return F.coalesce("language", F.lit("unknown"))


def percent(count: Column, total: Column, digits: int = 1) -> Column:
    """A share in percent, half away from zero; null where the total is 0."""
    return F.round(F.try_divide(F.lit(100.0) * count, total), digits)


def hero(documents: DataFrame) -> DataFrame:
    """One row over uploaded documents: total, languages ('unknown' is one), mean confidence, classified."""
    return documents.where(P.is_status("uploaded")).agg(
        F.count(F.lit(1)).alias("total"),
        F.countDistinct("language").alias("languages"),
        F.round(F.avg(F.col(CONFIDENCE).cast("double")), 2).alias("avg_confidence"),
        F.count("document_type").alias("classified"),
    )


def counts_by(documents: DataFrame, column: str, name: str, known: bool = True) -> DataFrame:
    """(name, n), most first; nulls are left out or counted."""
    rows = documents.where(F.col(column).isNotNull()) if known else documents
    return rows.groupBy(F.col(column).alias(name)).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), name)


def languages(documents: DataFrame, top: int | None = 20) -> DataFrame:
    """(language, n) with nulls merged into 'unknown', the most frequent first."""
    rows = documents.groupBy(known_language().alias("language")).agg(F.count(F.lit(1)).alias("n"))
    rows = rows.orderBy(F.desc("n"), "language")
    return rows.limit(top) if top else rows


def with_share(counts: DataFrame, name: str = "percentage", digits: int = 1) -> DataFrame:
    """Counts with their share of the sum of all rows given: few groups, so one partition is enough."""
    return counts.withColumn(name, percent(F.col("n"), F.sum("n").over(W.partitionBy()), digits))


def shares_of(counts: DataFrame, total: DataFrame, digits: int = 1) -> DataFrame:
    """Counts with their share of another table's n, summed."""
    whole = F.broadcast(total.agg(F.sum("n").alias("_total")))  # one row
    return counts.join(whole).withColumn("percentage", percent(F.col("n"), F.col("_total"), digits)).drop("_total")


def facets(documents: DataFrame, top_languages: int = 20, **chosen) -> DataFrame:
    """(facet, value, n): counts of types, topics and languages, each under the filter without its own dimension.

    One pass: a row is read if it fits any of the three filters, and counts in those that it fits.
    """
    spec = {"type": "document_type", "topic": "document_topic", "lang": "language"}
    fits = {name: P.facet_filter(**chosen, exclude=name) for name in spec}
    rows = documents.where(reduce(lambda a, b: a | b, fits.values()))
    entries = F.array(
        *[
            F.when(fits[name], F.struct(F.lit(name).alias("facet"), (known_language() if name == "lang" else F.col(c)).alias("value")))
            for name, c in spec.items()
        ]
    )
    counted = (
        rows.select(F.explode(F.filter(entries, lambda e: e.isNotNull() & e["value"].isNotNull())).alias("e"))
        .groupBy("e.facet", "e.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rank = F.row_number().over(W.partitionBy("facet").orderBy(F.desc("n"), "value"))
    ranked = counted.withColumn("_rank", rank)
    return ranked.where((F.col("facet") != "lang") | (F.col("_rank") <= top_languages)).select("facet", "value", "n")


def corpus_stats(documents: DataFrame) -> DataFrame:
    return documents.where(P.classified()).agg(
        F.count(F.lit(1)).alias("classified"), F.countDistinct("language").alias("languages")
    )


def within(documents: DataFrame, column: str, value: str, by: str, name: str) -> DataFrame:
    """Counts of one dimension inside one value of another."""
    return counts_by(documents.where(F.col(column) == value), by, name)


def facet_languages(documents: DataFrame, column: str, value: str, top: int = 10) -> DataFrame:
    """The top languages of a facet with their share of these top ones, and how many languages it has in all."""
    rows = documents.where((F.col(column) == value) & F.col("language").isNotNull())
    best = with_share(counts_by(rows, "language", "language").limit(top))
    return best.join(F.broadcast(rows.agg(F.countDistinct("language").alias("languages"))))


def histogram(documents: DataFrame) -> DataFrame:
    """(range, n, percentage, position) of classified documents' confidence, high to low; empty ranges are left out."""
    rows = documents.where(P.classified() & F.col(CONFIDENCE).isNotNull())
    order = F.create_map(*[F.lit(x) for i, name in enumerate([*(n for _, n in HISTOGRAM), BELOW]) for x in (name, i)])
    counted = rows.groupBy(band(CONFIDENCE, HISTOGRAM, BELOW).alias("range")).agg(F.count(F.lit(1)).alias("n"))
    return with_share(counted).withColumn("position", F.element_at(order, F.col("range"))).orderBy("position")


def stage_stats(documents: DataFrame) -> DataFrame:
    """One row: the progress of extraction, embedding, clustering and labelling."""
    return documents.agg(
        F.count_if(P.extracted()).alias("extracted"),
        F.count_if(P.extract_pending()).alias("extract_pending"),
        F.count_if(P.extract_error()).alias("extract_errors"),
        F.count_if(P.embedded()).alias("embedded"),
        F.count_if(P.embed_skipped()).alias("embed_skipped"),
        F.count_if(P.embed_selectable()).alias("embed_pending"),
        F.count_if(F.col("classified_at").isNotNull()).alias("clustered"),
        F.count_if(P.cluster_selectable()).alias("cluster_pending"),
        F.countDistinct("cluster_id").alias("clusters"),
        F.count("document_type").alias("labelled"),
        F.count_if(P.label_pending()).alias("label_pending"),
        F.count_if(P.label_selectable()).alias("label_selectable"),
    )


def label_progress(documents: DataFrame) -> DataFrame:
    classifiable = P.extracted() & (F.col("word_count") > 0)
    done = documents.agg(
        F.count_if(classifiable).alias("classifiable"),
        F.count_if(classifiable & F.col("classification_model").isNotNull()).alias("classified"),
    )
    return done.withColumn("remaining", F.col("classifiable") - F.col("classified"))


def status_report(documents: DataFrame) -> DataFrame:
    """(part, name, n): counts by status, their total, and the stages."""
    by_status = counts_by(documents, "status", "name").select(F.lit("status").alias("part"), "name", "n")
    total = by_status.agg(F.sum("n").alias("n")).select(F.lit("status").alias("part"), F.lit("total").alias("name"), "n")
    stages = stage_stats(documents)
    names = ", ".join(f"'{c}', {c}" for c in stages.columns)
    rows = stages.selectExpr(f"stack({len(stages.columns)}, {names}) as (name, n)").select(F.lit("stage").alias("part"), "name", "n")
    return by_status.unionByName(total).unionByName(rows)


def sampling_counts(documents: DataFrame, codes: list[str]) -> DataFrame:
    """(language, n) of extracted documents with words, for some languages."""
    rows = documents.where(P.extracted() & (F.col("word_count") > 0) & F.col("language").isin(codes))
    return counts_by(rows, "language", "language")


def language_words(documents: DataFrame) -> DataFrame:
    """(language, n, avg_words) of extracted documents."""
    rows = documents.where(P.extracted() & F.col("language").isNotNull())
    return rows.groupBy("language").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("word_count")).cast("int").alias("avg_words")
    )


def label_quality(labels: DataFrame) -> DataFrame:
    """One row over label rows: how many, mean confidence, low, medium and high ones, and failed parses."""
    c = F.coalesce("confidence", F.lit(0.0))
    return labels.agg(
        F.count(F.lit(1)).alias("total"),
        F.round(F.avg(c), 4).alias("avg_confidence"),
        F.count_if(c < 0.5).alias("low"),
        F.count_if((c >= 0.5) & (c < 0.8)).alias("medium"),
        F.count_if(c >= 0.8).alias("high"),
        F.count_if(c < 0.6).alias("below_0_6"),
        F.count_if(F.col("reasoning") == "Failed to parse LLM response").alias("parse_failures"),
    )


def counts_and_confidence(rows: DataFrame, column: str, confidence: str, digits: int = 3) -> DataFrame:
    """(value, n, avg_confidence) by a column."""
    return rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col(confidence).cast("double")), digits).alias("avg_confidence")
    )


def combinations(labels: DataFrame, top: int = 10) -> DataFrame:
    """The most frequent pairs of type and topic."""
    pairs = labels.groupBy("document_type", "document_topic").agg(F.count(F.lit(1)).alias("n"))
    return pairs.orderBy(F.desc("n"), "document_type", "document_topic").limit(top)


def unused(ids: DataFrame, used: DataFrame, column: str) -> DataFrame:
    """Ids that no row uses."""
    return ids.join(used.select(F.col(column).alias("id")), "id", "left_anti")


def confidence_bands(documents: DataFrame) -> DataFrame:
    """(band, n) of classified documents: high, medium, low, or unknown."""
    name = F.coalesce(band(CONFIDENCE, [(0.8, "high"), (0.5, "medium")], "low"), F.lit("unknown"))
    return documents.where(P.classified()).groupBy(name.alias("band")).agg(F.count(F.lit(1)).alias("n"))


def corpus_evaluation(documents: DataFrame, language: str | None = None) -> DataFrame:
    """(part, value, n, avg_confidence, percentage): types, topics, top languages, bands and models.

    Every share is of the classified total. The rows are reduced once, to counts by
    all five dimensions; the parts are sums of that small table.
    """
    rows = documents.where(P.classified())
    rows = rows.where(F.col("language") == language) if language else rows
    cells = rows.groupBy(
        F.col("document_type").alias("type"),
        F.col("document_topic").alias("topic"),
        known_language().alias("language"),
        F.coalesce(band(CONFIDENCE, [(0.8, "high"), (0.5, "medium")], "low"), F.lit("unknown")).alias("band"),
        F.coalesce("classification_model", F.lit("unknown")).alias("model"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(CONFIDENCE).cast("double")).alias("s"),
        F.count(CONFIDENCE).alias("m"),
    )
    parts = F.explode(
        F.array(*[F.struct(F.lit(p).alias("part"), F.col(p).alias("value")) for p in ("type", "topic", "language", "band", "model")])
    )
    grouped = cells.select(parts.alias("p"), "n", "s", "m").groupBy("p.part", "p.value").agg(
        F.sum("n").alias("n"), F.round(F.try_divide(F.sum("s"), F.sum("m")), 3).alias("avg_confidence")
    )
    rank = F.row_number().over(W.partitionBy("part").orderBy(F.desc("n"), "value"))
    total = F.sum(F.when(F.col("part") == "type", F.col("n"))).over(W.partitionBy())
    ranked = grouped.withColumn("_rank", rank).withColumn("percentage", percent(F.col("n"), total))
    return ranked.where((F.col("part") != "language") | (F.col("_rank") <= 20)).drop("_rank")


def duplicate_clusters(corrections: DataFrame) -> DataFrame:
    """One row: how many corrected ids several raw ids lead to, and the most that lead to one."""
    sizes = corrections.where(F.col("corrected_id").isNotNull()).groupBy("corrected_id").agg(F.count(F.lit(1)).alias("n"))
    return sizes.where("n > 1").agg(F.count(F.lit(1)).alias("clusters"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"))


def word_spread(rows: DataFrame, by: str, value: str = "word_count") -> DataFrame:
    """(by, low, upper_median, high): the upper median is the value at place n // 2 in order.

    The place is found by counts of each value, so no group is gathered in a row or task.
    """
    counted = counted_places(rows.where(F.col(value).isNotNull()), by, value)
    middle = F.floor(F.col("_of") / 2)
    at = (F.col("_before") <= middle) & (F.col("_before") + F.col("_n") > middle)
    return counted.groupBy(F.col("_by").alias(by)).agg(
        F.min("_value").alias("low"),
        F.max(F.when(at, F.col("_value"))).alias("upper_median"),
        F.max("_value").alias("high"),
    )


def rates(done: DataFrame, time: str, seconds: int = 1) -> DataFrame:
    """(begin, n, per_second) of the rows finished in each window of some seconds; windows without rows are left out."""
    return done.groupBy(F.window(time, f"{seconds} seconds").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("begin"), "n", (F.col("n") / seconds).alias("per_second")
    )


def throughput(outcomes: DataFrame) -> DataFrame:
    """One row over workers' (classified, errors, elapsed): sums, the longest time and the rate."""
    return outcomes.agg(
        F.sum("classified").alias("classified"),
        F.sum("errors").alias("errors"),
        F.max("elapsed").alias("elapsed"),
        F.try_divide(F.sum("classified"), F.max("elapsed")).alias("per_second"),
    )
