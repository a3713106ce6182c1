"""Quality rules as learned decision lists, in DataFrame functions only.

Sequential covering: a rule is grown, condition by condition (``statistic >= t``
or ``statistic < t``), on part of the labelled rows still uncovered; it is pruned
on the rest of them, added to the list, and the rows it covers are set aside. The
list becomes one ordered ``CASE`` expression over the statistics, so applying it
is a projection. Learning reads a bounded sample of labelled statistics
(``max_rows``, by a hash of the id), never texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import BLANKS, table, text_or_empty

SYMBOLS = "[#*$%&|<>]"
#: The statistics that rules may test, as SQL over the counts.
RATES = {
    "n_words": "cast(n_words as double)",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_rate": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_word_rate": "n_repeat_words / greatest(n_words, 1)",
    "upper_rate": "n_upper / greatest(word_chars, 1)",
}


def _count_repeat_words() -> Column:
    """Words that lie in a 3-word window that the text holds twice or more.

    Windows are hashed to 64 bits; the low bits, as many as the positions need,
    are replaced by the window's position, so that one sort of longs brings equal
    windows together with their places. Where the words of two neighbours differ
    though their bits agree, the windows found so far are sorted by their words.
    """
    return F.expr(
        """
        CASE WHEN n_words < 4 THEN 0L ELSE aggregate(
          sort_array(CASE WHEN clash THEN transform(
            filter(by_words, (x, j) -> (j > 0 AND x.w = by_words[j - 1].w) OR (j < size(by_words) - 1 AND x.w = by_words[j + 1].w)), x -> x.p)
            ELSE transform(together, p -> pmod(p, room)) END),
          struct(0L AS covered, -3L AS last),
          (a, i) -> struct(a.covered + least(3L, i - a.last) AS covered, i AS last),
          a -> a.covered) END
        """
    )


#: Windows whose bits agree with a neighbour's, whether words differ there, and, only then, these windows by their words.
_TOGETHER = """filter(sorted, (p, j) -> (j > 0 AND p - pmod(p, room) = sorted[j - 1] - pmod(sorted[j - 1], room))
  OR (j < n_words - 3 AND p - pmod(p, room) = sorted[j + 1] - pmod(sorted[j + 1], room)))"""
_CLASH = """exists(transform(together, (p, j) -> j > 0 AND p - pmod(p, room) = together[j - 1] - pmod(together[j - 1], room) AND NOT (
  _words[pmod(p, room)] = _words[pmod(together[j - 1], room)] AND _words[pmod(p, room) + 1] = _words[pmod(together[j - 1], room) + 1]
  AND _words[pmod(p, room) + 2] = _words[pmod(together[j - 1], room) + 2])), x -> x)"""
_BY_WORDS = """CASE WHEN clash THEN sort_array(transform(together, p -> struct(
  struct(_words[pmod(p, room)] AS a, _words[pmod(p, room) + 1] AS b, _words[pmod(p, room) + 2] AS c) AS w, pmod(p, room) AS p))) END"""


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the counts n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_upper.

    Null texts count as empty. Hashes only bring windows together; two count as
    equal when their words are. Rows are worked on one by one, repeated ones as well;
    an empty table gives an empty result.
    """
    words = F.array_remove(F.split("_text", BLANKS), "")
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumn("_text", text_or_empty(text_col)).withColumn("_words", words)
    out = out.withColumn("n_words", F.size("_words").cast("long"))
    out = out.withColumn("room", F.expr("shiftleft(1L, cast(ceil(log2(greatest(n_words, 2) + 1)) as int))"))
    hashes = F.expr(
        """
        CASE WHEN n_words < 4 THEN array() ELSE sort_array(transform(sequence(0L, n_words - 3), i ->
          xxhash64(_words[i], _words[i + 1], _words[i + 2]) - pmod(xxhash64(_words[i], _words[i + 1], _words[i + 2]), room) + i)) END
        """
    )
    out = out.withColumn("sorted", hashes)
    out = out.withColumn("together", F.expr(_TOGETHER)).withColumn("clash", F.expr(_CLASH)).withColumn("by_words", F.expr(_BY_WORDS))
    out = out.withColumn("_lines", lines)
    return (
        out.withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count("_text", F.lit(SYMBOLS)).cast("long"))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", _count_repeat_words())
        .withColumn("n_upper", F.regexp_count("_text", F.lit("[A-Z]")).cast("long"))
        .drop("_text", "_words", "_lines", "sorted", "together", "clash", "by_words", "room")
    )


@dataclass(frozen=True)
class Condition:
    name: str
    at_least: bool
    value: float

    def holds(self, row: dict) -> bool:
        return (row[self.name] >= self.value) == self.at_least

    def sql(self) -> str:
        return f"({RATES[self.name]}) {'>=' if self.at_least else '<'} {self.value!r}D"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    good: bool

    def holds(self, row: dict) -> bool:
        return all(c.holds(row) for c in self.conditions)


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the first that holds decides, else the default."""

    rules: tuple[Rule, ...]
    default: bool

    def decide(self, row: dict) -> bool:
        return next((r.good for r in self.rules if r.holds(row)), self.default)

    def column(self) -> Column:
        """One CASE expression; a statistic is never null, so neither is a verdict."""
        if not self.rules:
            return F.lit(self.default)
        whens = " ".join(
            f"WHEN {' AND '.join(c.sql() for c in r.conditions)} THEN {str(r.good).lower()}" for r in self.rules
        )
        return F.expr(f"CASE {whens} ELSE {str(self.default).lower()} END")


def _cuts(rows: list[dict], name: str, n: int) -> list[float]:
    values = sorted({r[name] for r in rows})
    picked = {values[i * (len(values) - 1) // n] for i in range(1, n)} if len(values) > 1 else set()
    return sorted(picked)


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """FOIL's information gain of a rule that keeps p of p0 and n of n0."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _grow(rows: list[dict], target: bool, cuts: int, longest: int) -> list[Condition]:
    rule: list[Condition] = []
    inside = rows
    while len(rule) < longest:
        p0 = sum(r["good"] == target for r in inside)
        n0 = len(inside) - p0
        if not p0 or not n0:
            break
        best, found = 1e-9, None
        for name in RATES:
            ordered = sorted(((r[name], r["good"] == target) for r in inside), key=lambda x: x[0])
            at = p_below = 0
            for value in _cuts(inside, name, cuts):
                while at < len(ordered) and ordered[at][0] < value:
                    p_below += ordered[at][1]
                    at += 1
                for at_least, p, n in ((False, p_below, at - p_below), (True, p0 - p_below, n0 - (at - p_below))):
                    if (g := _gain(p, n, p0, n0)) > best:
                        best, found = g, Condition(name, at_least, float(value))
        if not found:
            break
        rule.append(found)
        inside = [r for r in inside if found.holds(r)]
    return rule


def _worth(rule: list[Condition], rows: list[dict], target: bool) -> float:
    covered = [r["good"] == target for r in rows if all(c.holds(r) for c in rule)]
    return (2 * sum(covered) - len(covered)) / len(covered) if covered else -1.0


def learn(rows: list[dict], cuts: int = 32, longest: int = 4, most_rules: int = 12, least_precision: float = 0.9) -> DecisionList:
    """A decision list for rows (the statistics of RATES and good) by sequential covering.

    Rules are learned for the rarer class; the other one is the default. Every
    third row is held back for pruning. Without rows everything is good.
    """
    if not rows:
        return DecisionList((), True)
    target = 2 * sum(r["good"] for r in rows) < len(rows)
    grow, prune = [r for i, r in enumerate(rows) if i % 3], [r for i, r in enumerate(rows) if i % 3 == 0]
    rules: list[Rule] = []
    while len(rules) < most_rules and any(r["good"] == target for r in grow):
        rule = _grow(grow, target, cuts, longest)
        while len(rule) > 1 and _worth(rule[:-1], prune, target) >= _worth(rule, prune, target):
            rule = rule[:-1]
        if not rule or _worth(rule, prune, target) < 2 * least_precision - 1:
            break
        made = Rule(tuple(rule), target)
        rules.append(made)
        grow, prune = [r for r in grow if not made.holds(r)], [r for r in prune if not made.holds(r)]
    return DecisionList(tuple(rules), not target)


def labelled_statistics(
    docs: DataFrame, labels: DataFrame, max_rows: int = 10_000, id_col: str = "doc_id", label_col: str = "quality", text_col: str = "text"
) -> list[dict]:
    """The statistics of at most max_rows labelled documents, picked by a hash of the id; they come to the driver.

    Rows with a null id or label don't take part. Of rows that repeat an id the one
    with the smallest text hash is read, of several labels the largest counts; empty
    tables give no statistics.
    """
    known = labels.where(F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("_label"))
    # Only ids are ordered; the texts of the chosen are read after that.
    chosen = known.orderBy(F.xxhash64(id_col), id_col).limit(max_rows)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    joined = rows.join(F.broadcast(chosen.withColumnRenamed(id_col, "id")), "id").withColumn("h", F.xxhash64("text"))
    one = joined.groupBy("id", "_label").agg(F.min_by("text", "h").alias("text"))
    counts = with_statistics(one.withColumnRenamed("id", id_col))
    columns = [F.expr(sql).cast("double").alias(name) for name, sql in RATES.items()]
    found = counts.select(F.col(id_col), (F.col("_label") == 1).alias("good"), *columns).collect()
    return [r.asDict() for r in sorted(found, key=lambda r: (r[id_col], tuple(r)[2:]))]


def apply_rules(docs: DataFrame, rules: DecisionList, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, the counts, base_failed and kept of every row.

    Empty and null texts have no words and fail the base; null ids, repeated rows
    and further columns need no care, as rows are worked on one by one; an empty
    table gives an empty result.
    """
    counts = with_statistics(docs.select(F.col(id_col), F.col(text_col).alias("text")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counts.select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & rules.column()).alias("kept"),
    )


def op7_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = labelled_statistics(docs, table(spark, sf_dir, "labels"))
    return apply_rules(docs, learn(rows))
