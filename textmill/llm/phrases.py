"""Phrase collocations by contiguous pattern growth.

Frequent phrases are grown to the right, word by word, as PrefixSpan grows patterns
without gaps; a phrase is only as frequent as its parts, so nothing rare is extended.

1. Texts become blocks of word numbers, written once. Words are counted; those that
   are frequent in their language get ids, and all others end a piece like a full stop.
2. Every prefix of one word is extended in a distributed step, as at scale each of
   them is hot: blocks send their distinct pairs with counts to buckets, which add
   them up and answer each block with a bit for each pair.
3. A frequent pair is a prefix with a projected database: pointers to where it occurs,
   with the words that follow while they go on being frequent pairs. Equal
   continuations of a block are one row with a count. All rows of a prefix go to one
   task, which extends it depth-first; prefixes share tasks by hash. A prefix with
   more than `most` occurrences is dealt out by its continuations instead, and the
   counts of its parts are added up afterwards.
4. Scores, the dropping of contained phrases and the ranking are joins and windows
   over the frequent phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.blocks import bucket_bits, pack_hashes, unpack_hashes
from textmill.llm.common import Scratch, frugal, frugal_batches, table, text_or_empty
from textmill.llm.hashing import mixed

SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
BLOCK_BYTES = 8 << 20
#: A text is split into words so many bytes at a time.
SPAN = 1 << 20
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_PLAIN = bytes.maketrans(_UPPER + SEPARATORS + b"\t", _LOWER + b"." * len(SEPARATORS) + b" ")


class Words(dict):
    """Numbers of words, in the order of their first use; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        out = self[word] = len(self)
        return out


def numbered(body: bytes, words: Words) -> Iterator[np.ndarray]:
    """A text's words by number, a span at a time; 0 stands between pieces and at the end."""
    plain = body.translate(_PLAIN)
    at = 0
    while at < len(plain):
        end = at + SPAN
        if end < len(plain):  # cut between words only
            cut = max(plain.rfind(b" ", at, end), plain.rfind(b".", at, end))
            if cut < 0:
                cut = min((x for x in (plain.find(b" ", end), plain.find(b".", end)) if x >= 0), default=len(plain) - 1)
            end = cut + 1
        part = plain[at:end].replace(b".", b" . ").split()
        yield np.fromiter(map(words.__getitem__, part), np.uint32, len(part))
        at = end
    yield np.zeros(1, np.uint32)


def token_blocks(docs: DataFrame, lang_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """(block, lang, tokens, words, counts): texts of one language as numbers, the words by number (from 1) and their counts."""

    @frugal_batches
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        open_: dict[str, tuple[Words, list[np.ndarray]]] = {}
        held: dict[str, int] = {}

        def row(lang: str) -> pd.DataFrame:
            words, parts = open_.pop(lang)
            del held[lang]
            tokens = np.concatenate(parts)
            counts = np.bincount(tokens, minlength=len(words))[1:]
            names = [w.decode("utf-8", "replace") for w in words][1:]
            return pd.DataFrame(
                {"block": [number], "lang": [lang], "tokens": [tokens.tobytes()], "words": [names], "counts": [counts.astype(np.int64)]}
            )

        for batch in batches:
            for lang, body in zip(batch["lang"], batch["body"], strict=True):
                words, parts = open_.setdefault(lang, (Words(), []))
                parts.extend(numbered(bytes(body), words))
                held[lang] = held.get(lang, 0) + len(body) + 1
                full = lang if held[lang] >= block_bytes else None
                if full is None and sum(held.values()) >= 4 * block_bytes:
                    full = max(held, key=held.get)
                if full is not None:
                    yield row(full)
                    number += 1
        for lang in list(open_):
            yield row(lang)
            number += 1

    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), text_or_empty(text_col).cast("binary").alias("body"))
    return rows.mapInPandas(run, "block long, lang string, tokens binary, words array<string>, counts array<long>")


def frequent_words(blocks: DataFrame, least: int, scratch: Scratch) -> DataFrame:
    """(id, lang, word, f), written: words that occur least times in their language; ids are dense, from 1."""
    each = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x"))
    f = each.groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("f")).where(F.col("f") >= least)
    f = scratch.write(f.withColumn("at", F.monotonically_increasing_id()))
    sizes = f.groupBy(F.shiftright("at", 33).alias("part")).count().orderBy("part").collect()  # a row a partition
    if sum(r["count"] for r in sizes) >= 1 << 32:
        raise OverflowError("more frequent words than 32-bit ids")
    begins, total = [], 0
    for k in range(max((r["part"] for r in sizes), default=-1) + 1):
        begins.append(F.lit(total))
        total += next((r["count"] for r in sizes if r["part"] == k), 0)
    begin = F.element_at(F.array(*begins), F.shiftright("at", 33).cast("int") + 1) if begins else F.lit(0)
    out = scratch.write(f.select((begin + F.col("at").bitwiseAND((1 << 33) - 1) + 1).cast("long").alias("id"), "lang", "word", "f"))
    scratch.drop(f)
    return out


def with_ids(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """(block, tokens): the blocks with ids of frequent words instead of numbers, and one 0 for whatever lies between."""
    each = blocks.select("block", "lang", F.posexplode("words").alias("place", "word"))
    known = each.join(words.select("lang", "word", "id").hint("merge"), ["lang", "word"])
    known = known.groupBy("block").agg(F.collect_list(F.shiftleft(F.col("place").cast("long"), 32).bitwiseOR(F.col("id"))).alias("known"))

    @frugal_batches
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                tokens = np.frombuffer(row.tokens, np.uint32)
                pairs = np.asarray(row.known, np.int64)
                ids = np.zeros(int(row.n) + 1, np.uint32)
                ids[(pairs >> 32) + 1] = pairs & 0xFFFFFFFF
                out = ids[tokens]
                out = out[(out > 0) | np.append(True, out[:-1] > 0)]
                yield pd.DataFrame({"block": [row.block], "tokens": [out.tobytes()]})

    both = blocks.select("block", "tokens", F.size("words").alias("n")).join(known.hint("merge"), "block")
    return both.mapInPandas(run, "block long, tokens binary")


def pairs_of(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where two words follow each other, and both as one number."""
    at = np.flatnonzero((tokens[:-1] > 0) & (tokens[1:] > 0))
    return at, (tokens[at].astype(np.uint64) << np.uint64(32)) | tokens[at + 1]


def _by_bucket(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys' buckets, and the order by bucket that keeps them sorted in each."""
    bucket = (mixed(keys) >> np.uint64(64 - bits)).astype(np.int32)
    return bucket, np.argsort(bucket, kind="stable")


def _cuts(ordered: np.ndarray) -> Iterator[tuple[int, slice]]:
    begins = np.flatnonzero(np.diff(ordered, prepend=np.int32(-1)))
    for a, b in zip(begins, [*begins[1:], len(ordered)]):
        yield int(ordered[a]), slice(a, b)


def counted_pairs(blocks: DataFrame, bits: int, least: int, most: int) -> DataFrame:
    """The answers to each block, (block, bucket, n, frequent, hot), and as block -1 each bucket's frequent pairs (keys, counts)."""

    @frugal_batches
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                keys, counts = np.unique(pairs_of(np.frombuffer(row.tokens, np.uint32))[1], return_counts=True)
                bucket, order = _by_bucket(keys, bits)
                out = [
                    (b, row.block, pack_hashes(keys[order[cut]]), counts[order[cut]].astype(np.uint32).tobytes())
                    for b, cut in _cuts(bucket[order])
                ]
                yield pd.DataFrame(out, columns=["bucket", "block", "keys", "counts"])

    @frugal
    def meet(group: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack_hashes(x) for x in group["keys"]]
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in group["counts"]]).astype(np.int64)
        keys, which = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, which, counts)
        ends = np.cumsum([len(p) for p in parts])[:-1]
        good = total >= least
        told = [[np.packbits(x).tobytes() for x in np.split(y[which], ends)] for y in (good, total > most)]
        return pd.DataFrame(
            {
                "block": [*group["block"], -1],
                "bucket": int(group["bucket"].iat[0]),
                "n": [*map(len, parts), int(good.sum())],
                "frequent": [*told[0], None],
                "hot": [*told[1], None],
                "keys": [*[None] * len(parts), keys[good].tobytes()],
                "counts": [*[None] * len(parts), total[good].tobytes()],
            }
        )

    sent = blocks.mapInPandas(send, "bucket int, block long, keys binary, counts binary")
    shape = "block long, bucket int, n int, frequent binary, hot binary, keys binary, counts binary"
    return sent.groupBy("bucket").applyInPandas(meet, shape)


def _bits(told, name: str) -> np.ndarray:
    return np.concatenate([np.unpackbits(np.frombuffer(x[name], np.uint8))[: x["n"]] for x in told]).astype(bool)


def projected(blocks: DataFrame, met: DataFrame, bits: int, send_bits: int, further: int) -> DataFrame:
    """(bucket, keys, next, counts, hot): for each frequent pair the words that follow it, up to `further` of them.

    Only what can be part of a longer frequent phrase is sent: a word follows if it
    makes a frequent pair with the one before it. 0 ends a continuation early.
    """
    told = met.where("block >= 0").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "n", "frequent", "hot"))).alias("told"))

    @frugal_batches
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                tokens = np.frombuffer(row.tokens, np.uint32)
                at, keys = pairs_of(tokens)
                known, which = np.unique(keys, return_inverse=True)
                order = _by_bucket(known, bits)[1]
                good, hot = np.zeros((2, len(known)), dtype=bool)
                good[order], hot[order] = _bits(row.told, "frequent"), _bits(row.told, "hot")
                goes_on = np.zeros(len(tokens) + further + 1, dtype=bool)
                goes_on[at] = good[which]
                here = goes_on[at] & goes_on[at + 1]
                at, keys, hot = at[here], keys[here], hot[which][here]
                padded = np.append(tokens, np.zeros(further + 1, np.uint32))
                after, alive = np.zeros((further, len(at)), np.uint32), np.ones(len(at), dtype=bool)
                for k in range(further):
                    alive = alive & goes_on[at + 1 + k]
                    after[k] = np.where(alive, padded[at + 2 + k], 0)
                order = np.lexsort((*after[::-1], keys))
                keys, hot, after = keys[order], hot[order], after[:, order]
                new = np.ones(len(keys), dtype=bool)
                new[1:] = (keys[1:] != keys[:-1]) | (after[:, 1:] != after[:, :-1]).any(0)
                begins = np.flatnonzero(new)
                counts = np.diff(np.append(begins, len(keys))).astype(np.uint32)
                keys, hot, after = keys[begins], hot[begins], after[:, begins]
                name = keys.copy()
                for k in range(further):  # a hot prefix's rows are dealt out by all of their words
                    name = np.where(hot, mixed(name + after[k]), name)
                bucket, order = _by_bucket(name, send_bits)
                out = [
                    (b, pack_hashes(keys[o]), after[:, o].tobytes(), counts[o].tobytes(), hot[o].tobytes())
                    for b, o in ((b, order[cut]) for b, cut in _cuts(bucket[order]))
                ]
                yield pd.DataFrame(out, columns=["bucket", "keys", "next", "counts", "hot"])

    both = blocks.join(told.hint("merge"), "block")
    return both.mapInPandas(send, "bucket int, keys binary, next binary, counts binary, hot binary")


def grow(prefix: tuple[int, ...], after: np.ndarray, counts: np.ndarray, least: int, part: bool, found: list) -> None:
    """Extend a prefix by each frequent next word, depth-first.

    after: the words that follow its occurrences, a row for each depth, sorted, so
    that the occurrences of a longer prefix are a range of these; counts: how often
    each. With part this task has only some of the prefix's rows: whatever isn't of
    full length counts in part, and nothing of it is pruned here.
    """
    begins = np.flatnonzero(np.diff(after[0], prepend=-1))
    totals = np.add.reduceat(counts, begins)
    ends = np.append(begins[1:], len(counts))
    floor = 1 if part and len(after) > 1 else least
    for k in np.flatnonzero((totals >= floor) & (after[0][begins] > 0)):
        longer = (*prefix, int(after[0][begins[k]]))
        found.append((longer, int(totals[k])))
        if len(after) > 1:
            grow(longer, after[1:, begins[k] : ends[k]], counts[begins[k] : ends[k]], least, part, found)


def grown(sent: DataFrame, least: int, further: int) -> DataFrame:
    """(ids, f): frequent phrases of three words or more; a hot prefix's in parts."""

    @frugal
    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([unpack_hashes(x) for x in group["keys"]])
        after = np.concatenate([np.frombuffer(x, np.uint32).reshape(further, -1) for x in group["next"]], axis=1).astype(np.int64)
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in group["counts"]]).astype(np.int64)
        hot = np.frombuffer(b"".join(group["hot"]), dtype=bool)
        order = np.lexsort((*after[::-1], keys))
        keys, after, counts, hot = keys[order], after[:, order], counts[order], hot[order]
        begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        found: list[tuple[tuple[int, ...], int]] = []
        for a, b in zip(begins, np.append(begins[1:], len(keys)), strict=True):
            key = int(keys[a])
            grow((key >> 32, key & 0xFFFFFFFF), after[:, a:b], counts[a:b], least, bool(hot[a]), found)
        return pd.DataFrame({"ids": pd.Series([list(p) for p, _ in found], dtype=object), "f": np.array([n for _, n in found], np.int64)})

    return sent.groupBy("bucket").applyInPandas(run, "ids array<long>, f long")


def _pair_rows(met: DataFrame) -> DataFrame:
    """(ids, f) of the frequent pairs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for keys, counts in zip(batch["keys"], batch["counts"], strict=True):
                key = np.frombuffer(keys, np.uint64)
                ids = np.stack([key >> np.uint64(32), key & np.uint64(0xFFFFFFFF)], axis=1).astype(np.int64)
                yield pd.DataFrame({"ids": pd.Series(list(ids), dtype=object), "f": np.frombuffer(counts, np.int64)})

    return met.where("block < 0").select("keys", "counts").mapInPandas(run, "ids array<long>, f long")


def frequent_phrases(
    docs: DataFrame, scratch: Scratch, least: int, max_words: int, most: int, lang_col: str, text_col: str, block_bytes: int = BLOCK_BYTES
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ids, f) of all phrases of 1 to max_words words that occur least times in a language; (id, lang, word, f); and (lang, n)."""
    blocks = scratch.write(token_blocks(docs, lang_col, text_col, block_bytes), row_group_mb=32)
    words = frequent_words(blocks, least, scratch)
    sizes = blocks.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("n"))
    sizes = scratch.write(sizes.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0"))
    mapped = scratch.write(with_ids(blocks, words), row_group_mb=32)
    scratch.drop(blocks)
    n_tokens = mapped.agg(F.sum(F.length("tokens"))).first()[0] or 0
    bits = bucket_bits(n_tokens // 4, least=4)
    met = scratch.write(counted_pairs(mapped, bits, least, most))
    phrases = words.select(F.array("id").alias("ids"), "f").union(_pair_rows(met))
    if max_words > 2:
        sent = projected(mapped, met, bits, bits, max_words - 2)
        longer = grown(sent, least, max_words - 2).groupBy("ids").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
        phrases = phrases.union(longer)
    phrases = scratch.write(phrases)
    scratch.drop(mapped, met)
    return phrases, words, sizes


def scored(phrases: DataFrame, contained: int = 80, factor: int = 2_000_000) -> DataFrame:
    """(ids, a, l, r, score) of the phrases of two words or more that no longer one makes up for.

    A phrase's score is that of its lowest cut, floor(factor * a / (l + r)); it goes if
    a longer one that contains it has contained percent of its occurrences.
    """
    many = phrases.where(F.size("ids") >= 2).select("ids", F.col("f").alias("a"))
    cuts = many.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.select(
        "ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("first"),
        F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("rest"),
    )
    l, r = (phrases.select(F.col("ids").alias(c), F.col("f").alias(n)) for c, n in (("first", "l"), ("rest", "r")))
    cuts = cuts.join(l.hint("merge"), "first").join(r.hint("merge"), "rest")
    exact = F.floor(F.lit(factor).cast("decimal(10,0)") * F.col("a").cast("decimal(18,0)") / (F.col("l") + F.col("r")).cast("decimal(18,0)"))
    # The quotient is rounded; whole numbers are put right by comparing products.
    product, divisor = F.lit(factor).cast("decimal(10,0)") * F.col("a").cast("decimal(18,0)"), (F.col("l") + F.col("r")).cast("decimal(18,0)")
    score = F.when(exact.cast("decimal(18,0)") * divisor > product, exact - 1).otherwise(exact).cast("long")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    lowest = cuts.groupBy("ids", "a").agg(lowest).select("ids", "a", "cut.l", "cut.r", "cut.score")
    spans = F.expr(
        """flatten(transform(sequence(2, size(ids) - 1), n ->
             transform(sequence(1, size(ids) - n + 1), i -> slice(ids, i, n))))"""
    )
    inside = many.where(F.size("ids") >= 3).select(F.col("a").alias("longer"), F.explode(spans).alias("ids"))
    inside = inside.groupBy("ids").agg(F.max("longer").alias("longer"))
    kept = lowest.join(inside.hint("merge"), "ids", "left")
    hundred = (F.lit(n).cast("decimal(3,0)") * F.col(c).cast("decimal(18,0)") for n, c in ((100, "longer"), (contained, "a")))
    more, enough = hundred
    return kept.where(F.col("longer").isNull() | (more < enough)).drop("longer")


def collocations(
    docs: DataFrame,
    least: int = 30,
    max_words: int = 4,
    top: int = 2000,
    most: int = 1 << 22,
    lang_col: str = "lang",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first phrases of each language by score, then count, then the phrase's bytes.

    Words are runs of anything but spaces and tabs, A-Z as a-z, in the pieces between
    .,;:!? and line ends. Every row's text counts, repeated rows and null or repeated
    ids as well; a null language is und; null and empty texts have no words; an
    empty table, or one without frequent phrases, gives no rows; other columns are
    ignored. Counts are exact: words and phrases are told apart by themselves, not
    by hashes. A text is held whole, and so is a word, however long.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    phrases, words, sizes = frequent_phrases(docs, scratch, least, max_words, most, lang_col, text_col, block_bytes)
    names = words.select(F.col("id"), "lang", "word")
    found = scored(phrases).withColumn("id", F.element_at("ids", 1)).join(names.select("id", "lang").hint("merge"), "id").drop("id")
    place = F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))
    best = scratch.write(found.withColumn("place", place).where(F.col("place") <= top).drop("place"))
    each = best.select("lang", "ids", F.posexplode("ids").alias("i", "id")).join(names.select("id", "word").hint("merge"), "id")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ")
    told = best.join(each.groupBy("ids").agg(text.alias("phrase")).hint("merge"), "ids").join(sizes.hint("merge"), "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    out = told.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), sizes AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang
), grams AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
), f AS MATERIALIZED (
  SELECT lang, phrase, any_value(k) AS k, count(*) AS f FROM grams GROUP BY lang, phrase HAVING count(*) >= 30
), cand AS (
  SELECT lang, phrase, string_split(phrase, ' ') AS w, k, f AS a FROM f WHERE k >= 2
), cuts AS (
  SELECT c.lang, c.phrase, c.a, j, x.f AS l, y.f AS r, CAST(2000000 AS HUGEINT) * c.a // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1:], ' ')
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), parts AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM cand, (SELECT unnest([2, 3]) AS m) WHERE m < k)
  GROUP BY ALL
), kept AS (
  SELECT l.* FROM lowest l LEFT JOIN parts p ON p.lang = l.lang AND p.phrase = l.phrase
  WHERE p.longer IS NULL OR CAST(100 AS HUGEINT) * p.longer < CAST(80 AS HUGEINT) * l.a
)
SELECT k.lang, row_number() OVER best AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM kept k JOIN sizes s ON s.lang = k.lang
WINDOW best AS (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER best <= 2000
"""
