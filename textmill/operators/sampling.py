"""Stratified samples: allocation, terciles, round robin by domain, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions.text import domain
from textmill.operators import predicates as P
from textmill.sources.store import written


def random_key(id_col: str = "id", seed: int = 42) -> Column:
    """A reproducible random order; any engine has MD5."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def allocation(counts: DataFrame, total: int) -> DataFrame:
    """(language, n, allocated): shares of total, rounded half to even, at least min(50, total // languages).

    What rounding leaves or takes is made up by the largest allocation, which stays at least 1.
    """
    whole = counts.agg(F.sum("n").alias("_sum"), F.count(F.lit(1)).alias("_k"))
    rows = counts.join(F.broadcast(whole))  # one row
    share = F.bround(F.lit(float(total)) * F.col("n") / F.col("_sum"), 0).cast("bigint")
    least = F.least(F.lit(50), F.floor(F.lit(total) / F.col("_k")))
    rows = rows.withColumn("allocated", F.greatest(least, share).cast("bigint"))
    everything = W.partitionBy()
    rank = F.row_number().over(everything.orderBy(F.desc("allocated"), F.desc("n"), "language"))
    rows = rows.withColumn("_rank", rank).withColumn("_left", F.lit(total) - F.sum("allocated").over(everything))
    fixed = F.when(F.col("_rank") == 1, F.greatest(F.lit(1), F.col("allocated") + F.col("_left"))).otherwise(F.col("allocated"))
    return rows.select("language", "n", fixed.cast("bigint").alias("allocated"))


def terciles(rows: DataFrame, by: str, value: str = "word_count", id_col: str = "id") -> DataFrame:
    """rows with tercile 0, 1 or 2 of value inside a group; the last one takes the remainder.

    Places are counted by value; only the rows of a value that lies across a border
    are ordered by id, so a group is never sorted by one task.
    """
    counted = counted_places(rows, by, value)
    third = F.floor(F.col("_of") / 3)
    border = F.array(third, 2 * third)
    joined = rows.join(counted, rows[by].eqNullSafe(F.col("_by")) & rows[value].eqNullSafe(F.col("_value")))
    first, last = F.col("_before"), F.col("_before") + F.col("_n") - 1

    def tercile(r: Column) -> Column:
        return F.when(r < border[0], 0).when(r < border[1], 1).otherwise(2)

    across = tercile(first) != tercile(last)
    place = F.col("_before") + F.row_number().over(W.partitionBy("_by", "_value").orderBy(id_col)) - 1
    sure = joined.where(~across).withColumn("tercile", tercile(first))
    ordered = joined.where(across).withColumn("tercile", tercile(place))
    return sure.unionByName(ordered).select(*rows.columns, "tercile")


def counted_places(rows: DataFrame, by: str, value: str) -> DataFrame:
    """(_by, _value, _n, _before, _of): rows of each value, those of smaller ones in its group, and of the group."""
    counts = rows.groupBy(F.col(by).alias("_by"), F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    group = W.partitionBy("_by")
    before = F.coalesce(F.sum("_n").over(group.orderBy("_value").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return counts.withColumn("_before", before).withColumn("_of", F.sum("_n").over(group))


def numbered(rows: DataFrame, by: list[str], digits: Column, order: list[Column | str], name: str) -> DataFrame:
    """rows with their places (from 1) in a group by digits and then order; digits are a beginning of the order.

    Rows are counted by their digits, so that only those of one group and the same
    digits are ever sorted together.
    """
    keyed = rows.withColumn("_group", F.struct(*by)).withColumn("_digits", digits)
    counted = counted_places(keyed, "_group", "_digits").drop("_of")
    joined = keyed.join(counted, keyed["_group"].eqNullSafe(F.col("_by")) & keyed["_digits"].eqNullSafe(F.col("_value")))
    place = F.col("_before") + F.row_number().over(W.partitionBy("_by", "_value").orderBy(*order))
    return joined.select(*rows.columns, place.alias(name))


def round_robin(rows: DataFrame, groups: list[str], domain_col: str, n: Column, id_col: str = "id", seed: int = 42) -> DataFrame:
    """Of each group, n rows: one of every domain, then a second one, and so on.

    Neither a group nor a domain is sorted by one task, even if it has all rows: places
    come from counts by the first digits of the random orders. Rows whose turn is over
    n can't be among the first n and are dropped before the second order.
    """
    key, of_domain = random_key(id_col, seed), F.md5(F.concat(F.col(domain_col), F.lit(f":{seed}")))
    turns = numbered(rows, [*groups, domain_col], F.left(key, F.lit(4)), [key, id_col], "turn").where(F.col("turn") <= n)
    within = numbered(turns, [*groups, "turn"], F.left(of_domain, F.lit(4)), [of_domain, domain_col], "_within")
    # A row for each group and turn, so n at most of a group.
    sizes = turns.groupBy(F.struct(*groups).alias("_g"), F.col("turn").alias("_turn")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = F.coalesce(F.sum("_rows").over(W.partitionBy("_g").orderBy("_turn").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumn("_earlier", earlier)
    joined = within.join(sizes, F.struct(*groups).eqNullSafe(F.col("_g")) & (F.col("turn") == F.col("_turn")))
    placed = joined.withColumn("place", F.col("_earlier") + F.col("_within"))
    return placed.select(*rows.columns, F.col("turn").cast("int"), F.col("place").cast("int")).where(F.col("place") <= n)


def candidates(documents: DataFrame, language: str, pool: int, seed: int = 42) -> DataFrame:
    """At most pool extracted documents of a language that have words, in random order."""
    rows = documents.where(P.extracted() & (F.col("language") == language) & (F.col("word_count") > 0))
    return rows.orderBy(random_key(seed=seed), "id").limit(pool)


def stratified(documents: DataFrame, allocated: DataFrame, exclude: DataFrame | None = None, seed: int = 42) -> DataFrame:
    """The sample of all languages at once.

    Per language: the pool (ten times the allocation, 100,000 at most) less the
    excluded ids; all of it if that is no more than allocated; else a third from
    every tercile of word counts, what's left over from the first ones, each taken
    round robin over the domains.
    """
    pool = F.least(10 * F.col("allocated"), F.lit(100_000))
    quotas = allocated.select("language", "allocated", pool.alias("_pool"), ((1.2 * pool + 1000) / F.col("n")).alias("_share"))
    # One row a language. The pool is the rows with the smallest keys; all but a little more
    # than these are dropped by the key alone, before anything is shuffled.
    rows = documents.where(P.extracted() & (F.col("word_count") > 0)).join(F.broadcast(quotas), "language")
    rows = rows.withColumn("_key", random_key(seed=seed))
    rows = rows.where(F.conv(F.left("_key", F.lit(8)), 16, 10).cast("double") < F.col("_share") * float(1 << 32))
    drawn = F.row_number().over(W.partitionBy("language").orderBy("_key", "id"))
    rows = rows.withColumn("_drawn", drawn).where(F.col("_drawn") <= F.col("_pool"))
    if exclude is not None:
        rows = rows.join(exclude.select("id"), "id", "left_anti")
    # A pool is of bounded size, so one task may order it.
    pool = W.partitionBy("language")
    third = F.floor(F.count(F.lit(1)).over(pool) / 3)
    place = F.row_number().over(pool.orderBy("word_count", "id")) - 1
    rows = rows.withColumn("domain", domain("source_url"))
    rows = rows.withColumn("tercile", F.when(place < third, 0).when(place < 2 * third, 1).otherwise(2))
    size = F.count(F.lit(1)).over(W.partitionBy("language"))
    third = F.floor(F.col("allocated") / 3)
    quota = third + (F.col("tercile") < F.col("allocated") - 3 * third).cast("int")
    quota = F.when(F.col("_size") <= F.col("allocated"), F.col("_size")).otherwise(quota)
    return round_robin(rows.withColumn("_size", size), ["language", "tercile"], "domain", quota, seed=seed).drop(
        "_drawn", "_size", "_key", "_pool", "_share", "turn", "place", "allocated"
    )


def split(rows: DataFrame, label: str, share: float = 0.15, id_col: str = "id", seed: int = 42) -> DataFrame:
    """rows with is_validation: of each label exactly round(share * n), by the random order.

    Rows are counted by the first digits of their keys; only those of the digits at
    the border are put in order, so a label is never sorted by one task.
    """
    keyed = rows.withColumn("_key", random_key(id_col, seed)).withColumn("_digits", F.left("_key", F.lit(4)))
    counted = counted_places(keyed, label, "_digits")
    joined = keyed.join(counted, keyed[label].eqNullSafe(F.col("_by")) & (keyed["_digits"] == F.col("_value")))
    most = F.round(F.lit(share) * F.col("_of"))
    across = (F.col("_before") < most) & (F.col("_before") + F.col("_n") > most)
    place = F.col("_before") + F.row_number().over(W.partitionBy("_by", "_value").orderBy("_key", id_col))
    sure = joined.where(~across).withColumn("is_validation", F.col("_before") < most)
    ordered = joined.where(across).withColumn("is_validation", place <= most)
    return sure.unionByName(ordered).select(*rows.columns, "is_validation")


def id_chunks(rows: DataFrame, workers: int, id_col: str = "id") -> DataFrame:
    """rows with worker: slices of ceil(n / workers) in the order of ids.

    Ids are dealt by ranges and numbered within each, once, into a written table; the
    ranges' sizes, a row each, give the rest of a place.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.select(id_col).repartitionByRange(parts, id_col).sortWithinPartitions(id_col)
    own = F.monotonically_increasing_id()
    placed = written(ranged.withColumn("_part", F.shiftright(own, 33)).withColumn("_at", own.bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumn("_before", before).withColumn("_of", F.sum("_n").over(W.partitionBy()))
    joined = placed.join(F.broadcast(sizes), "_part")  # a row a range
    place = F.col("_before") + F.col("_at")
    return joined.select(id_col, F.floor(place / F.ceil(F.col("_of") / workers)).cast("int").alias("worker"))
