"""Exact deduplication by distributed most-significant-digit radix partitioning.

The digits of a text are successive runs of its UTF-8 bytes. A round deals every
live group out by its next digit: rows that are then alone are singletons, and a
group whose digit is shorter than the round's width has ended, so its texts are
equal byte for byte. All others go on to the next digit. Nothing is decided by a
digest.

Digits start at ``first_digit`` bytes and widen fourfold a round, so a text of n
bytes takes O(log n) rounds, and a round carries only the bytes not yet read of
the rows still in a group. Each round pre-aggregates before its shuffle (one row
per group, digit and task), so a group with a third of all rows costs the
aggregation one row a task; the join that hands the new group back can be split
on its large side by adaptive execution.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import Scratch, table, text_or_empty


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    first_digit: int = 64,
    widest_digit: int = 1 << 20,
    keep: str = "largest",
) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; a null text counts as empty. Of equal texts
    the row with the largest (or smallest) id stays. Defined results of odd
    input: an empty table gives an empty result; rows that repeat id and text
    form one group and are all marked kept if their id is the one that stays;
    a null id never stays beside a non-null one, and a group of null ids only
    keeps all its rows with keep_id null; other columns are ignored.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    pick = F.max if keep == "largest" else F.min
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    live = docs.select(
        F.col(id_col).alias("id"),
        F.lit(0).cast("long").alias("label"),
        text_or_empty(text_col).cast("binary").alias("rest"),
        F.sha2(text_or_empty(text_col), 256).alias("sha"),
    )
    done: list[DataFrame] = []
    width = first_digit
    while True:
        digit = F.substring("rest", 1, width)
        live = live.withColumn("digit", digit)
        groups = live.groupBy("label", "digit").agg(pick("id").alias("keep_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
        # A group's label is its number, which is fixed once it is written.
        groups = groups.withColumn("next", F.monotonically_increasing_id())
        # Written, the groups are a join side of their own, and a hot group's rows can be
        # split. They grow with the input, so they are never broadcast, however few.
        groups = scratch.write(groups)
        ended = F.length("digit") < width
        dealt = live.join(groups.hint("merge"), ["label", "digit"], "left").select(
            "id",
            "sha",
            F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
            F.coalesce("next", F.lit(0)).alias("label"),
            (F.col("n").isNull() | ended).alias("final"),
            F.when(F.col("n").isNotNull() & ~ended, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
        )
        dealt = scratch.write(dealt)
        scratch.drop(groups)
        done.append(dealt.where("final"))
        if dealt.where("not final").isEmpty():
            break
        live = dealt.where("not final").select("id", "label", "rest", "sha")
        width = min(width * 4, widest_digit)
    return reduce(DataFrame.unionByName, [d.select("id", "keep_id", "group_size", "sha") for d in done]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


OP6_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
