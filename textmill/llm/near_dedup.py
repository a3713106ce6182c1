"""Near-duplicate detection: MinHash signatures and a multi-index Hamming join.

A document's set of word shingles becomes a signature of ``chunks * 4`` symbols of
16 bits. The signature is split into chunks, and every chunk is indexed under each
of its four ways to leave one symbol out. By the pigeonhole principle two
signatures that differ in fewer than 2 * chunks symbols have a chunk with at most
one error, so they meet in at least one key: all pairs under that distance are
found. (A pair of similarity 0.75 misses every key with probability 1.5e-6.)

What meets is never expanded to all pairs of a group:

1. Documents with equal sets (equal in size and in two 64-bit sums of hashes) are
   one class; only classes go on.
2. Every key links its members to the one that comes first (smallest id). Senders
   do that for their own part first, so a key costs its bucket one entry a sender.
   Each class tries the earliest of its heads on the full sets, and then those
   others that it isn't connected with by now.
3. What is left is proving that no link between different components was missed.
   Two classes that are to be linked have a key in common, so a key whose members
   lie in several components has those outside its largest one compared with all
   of its members, in blocks: by signatures first, each pair in its first common
   key only, which tells the classes whose sets a task needs; then by these sets.
   A task returns the links that join components, never pairs.
4. Before that, large keys lose the members that can have no partner: similar sets
   share one of the few shingles that come first when the rare ones do (prefix
   filtering), so unlike pages that have only a template in common are gone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.blocks import bucket_bits
from textmill.llm.common import Scratch, frugal_batches, table, text_or_empty
from textmill.llm.graph import components, merged
from textmill.llm.hashing import WordHashes, mixed, windows

PER_CHUNK = 4
#: A task of step 3 holds sets of about so many bytes on each side, or a single larger one.
BLOCK_BYTES = 16 << 20
#: Counters of the sketch that tells rare shingles from common ones, whatever the corpus; a power of two.
COUNTERS = 1 << 20
_SECOND = np.uint64(0xD6E8FEB86659FD93)
_LAST = 2**63 - 1


def shingles(text: bytes, words: int, memory: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; with fewer words, of all of them as one."""
    own = text.lower().split()  # of bytes: lower-cases A-Z, splits at ASCII blanks
    return np.unique(windows(memory.of(own), min(words, len(own)))) if own else np.empty(0, np.uint64)


def signatures(sets: list[np.ndarray], chunks: int) -> np.ndarray:
    """Symbols (uint16, one row for each set) of sets that aren't empty."""
    n = chunks * PER_CHUNK
    if not sets:
        return np.empty((0, n), np.uint16)
    flat = np.concatenate(sets)
    begins = np.cumsum([0, *(len(s) for s in sets[:-1])])
    seeds = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.empty((len(sets), n), np.uint16)
    for k in range(n):
        least = np.minimum.reduceat((flat ^ seeds[k]) * (seeds[n + k] | np.uint64(1)), begins)
        out[:, k] = mixed(least) >> np.uint64(48)
    return out


def chunk_keys(symbols: np.ndarray) -> np.ndarray:
    """For each signature, chunks * 4 keys: a chunk's number and its symbols but one."""
    n, width = symbols.shape
    out = np.empty((n, width), np.uint64)
    s = symbols.astype(np.uint64)
    for c in range(width // PER_CHUNK):
        for gone in range(PER_CHUNK):
            key = np.full(n, c * PER_CHUNK + gone + 1, np.uint64)
            for j in range(PER_CHUNK):
                if j != gone:
                    key = mixed((key << np.uint64(16)) + s[:, c * PER_CHUNK + j] + (key >> np.uint64(48)))
            out[:, c * PER_CHUNK + gone] = key
    return out


def _read_signatures(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(len(column), -1)


def sketch(docs: DataFrame, words: int, chunks: int, span: int = 1 << 21) -> DataFrame:
    """(id, h, n, c1, c2, sig) of every row of (id, h, body): n, c1 and c2 tell its set, n is the set's size."""

    @frugal_batches
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = WordHashes()
        for batch in batches:
            at = 0
            while at < len(batch):
                sets, held, begin = [], 0, at
                while at < len(batch) and (held < span // 8 or at == begin):
                    sets.append(shingles(bytes(batch["body"].iat[at]), words, memory))
                    held += len(sets[-1])
                    at += 1
                sizes = np.array([len(s) for s in sets])
                some = np.flatnonzero(sizes)
                sig = [b""] * len(sets)
                c1, c2 = np.zeros((2, len(sets)), np.uint64)
                rows = signatures([sets[i] for i in some], chunks)
                for i, row in zip(some, rows, strict=True):
                    sig[i] = row.tobytes()
                    c1[i] = np.add.reduce(mixed(sets[i]), dtype=np.uint64)
                    c2[i] = np.add.reduce(mixed(sets[i] ^ _SECOND), dtype=np.uint64)
                part = batch.iloc[begin:at]
                yield pd.DataFrame(
                    {"id": part["id"], "h": part["h"], "n": sizes, "c1": c1.view(np.int64), "c2": c2.view(np.int64), "sig": sig}
                )

    return docs.mapInPandas(run, "id long, h long, n long, c1 long, c2 long, sig binary")


def _heads(keys: np.ndarray, order: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows sorted by (key, order, cls); which of them are the first of their key; and each row's first."""
    rows = np.lexsort((cls, order, keys))
    keys = keys[rows]
    first = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.empty(0, dtype=bool)
    return rows, first, rows[np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0))]


def key_links(classes: DataFrame, scratch: Scratch, bits: int) -> DataFrame:
    """Distinct (b, a, a_order): classes, and another one that has a key in common and comes before them by order.

    Keys are dealt to 2**bits buckets.
    """

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = chunk_keys(_read_signatures(batch["sig"]))
            cls, order = (np.repeat(batch[c].to_numpy(), keys.shape[1]) for c in ("cls", "order"))
            flat = keys.ravel()
            rows, first, head = _heads(flat, order, cls)
            own = np.unique(np.column_stack([cls[rows], cls[head], order[head]])[~first], axis=0)
            out = [(-1, b"", b"", b"", own.tobytes())]
            rows = rows[first]
            bucket = (flat[rows] >> np.uint64(64 - bits)).astype(np.int64)
            begins = np.flatnonzero(np.diff(bucket, prepend=-1))
            for x, y in zip(begins, np.append(begins[1:], len(rows)), strict=True):
                part = rows[x:y]
                out.append((int(bucket[x]), flat[part].tobytes(), cls[part].tobytes(), order[part].tobytes(), b""))
            yield pd.DataFrame(out, columns=["bucket", "keys", "cls", "order", "own"])

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        links = np.frombuffer(b"".join(group["own"]), np.int64).reshape(-1, 3)
        keys = np.frombuffer(b"".join(group["keys"]), np.uint64)
        cls, order = (np.frombuffer(b"".join(group[c]), np.int64) for c in ("cls", "order"))
        if len(keys):
            rows, first, head = _heads(keys, order, cls)
            links = np.concatenate([links, np.column_stack([cls[rows], cls[head], order[head]])[~first]])
        links = np.unique(links, axis=0)
        return pd.DataFrame(links[links[:, 0] != links[:, 1]], columns=["b", "a", "a_order"])

    sent = classes.select("cls", "order", "sig").mapInPandas(send, "bucket int, keys binary, cls binary, order binary, own binary")
    # The senders' own links have no bucket: they are dealt out evenly.
    spread = F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64("own"), F.lit(1 << bits))).otherwise(F.col("bucket"))
    met = sent.withColumn("bucket", spread.cast("int")).groupBy("bucket").applyInPandas(meet, "b long, a long, a_order long")
    return scratch.write(met.distinct())


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed(links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links (a, b, and further longs) whose sets are similar."""
    names = links.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = [
                similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                for x, y in zip(batch["x"], batch["y"], strict=True)
            ]
            yield batch.loc[np.array(good, dtype=bool), names]

    x = sets.select(F.col("cls").alias("a"), F.col("elements").alias("x"))
    y = sets.select(F.col("cls").alias("b"), F.col("elements").alias("y"))
    both = links.join(x.hint("merge"), "a").join(y.hint("merge"), "b")
    return both.select(*names, "x", "y").mapInPandas(run, ", ".join(f"{c} long" for c in names))


def with_comp(rows: DataFrame, comps: DataFrame, cls: str = "cls", comp: str = "comp") -> DataFrame:
    """rows with the component of each class in column cls: its own name, where comps (node, label) hasn't got it."""
    named = comps.select(F.col("node").alias(cls), F.col("label").alias("_label"))
    return rows.join(named.hint("merge"), cls, "left").withColumn(comp, F.coalesce("_label", cls)).drop("_label")


def key_rows(members: DataFrame, with_sig: bool = False) -> DataFrame:
    """(key, slot, cls, comp, n; and sig): a row for each key of members (cls, comp, n, sig)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = chunk_keys(_read_signatures(batch["sig"]))
            of = np.repeat(np.arange(len(batch)), keys.shape[1])
            out = {c: batch[c].to_numpy()[of] for c in ("cls", "comp", "n", *["sig"] * with_sig)}
            slot = np.tile(np.arange(keys.shape[1], dtype=np.int32), len(batch))
            yield pd.DataFrame({"key": keys.ravel().view(np.int64), "slot": slot, **out})

    shape = "key long, slot int, cls long, comp long, n long" + ", sig binary" * with_sig
    return members.select("cls", "comp", "n", "sig").mapInPandas(run, shape)


#: A task's name, and what tells a key.
TASK = ["at", "i", "j", "with_main"]
KEY = ["key", "slot"]


def open_keys(members: DataFrame, block: int) -> DataFrame:
    """The keys whose members lie in several components: their rows and bytes, main (largest) component, whether they are small, and their numbers of blocks."""
    per_comp = key_rows(members).groupBy(*KEY, "comp").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("n") * 8).alias("bytes"))
    main = F.max(F.struct("rows", "comp", "bytes")).alias("main")
    per_key = per_comp.groupBy(*KEY).agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("comps"), main)

    def blocks(rows, size):
        return F.ceil(F.greatest(rows / block, size / BLOCK_BYTES, F.lit(1))).cast("int")

    # Two classes that are all of a key are the key's link, which was tried.
    return per_key.where("comps > 1 and rows > 2").select(
        *KEY, "rows", "bytes", F.col("main.comp").alias("main"), ((F.col("rows") <= block) & (F.col("bytes") <= BLOCK_BYTES)).alias("small"),
        blocks(F.col("rows") - F.col("main.rows"), F.col("bytes") - F.col("main.bytes")).alias("out_blocks"),
        blocks(F.col("main.rows"), F.col("main.bytes")).alias("main_blocks"),
    )


def key_tasks(members: DataFrame, keys: DataFrame, tasks: int) -> DataFrame:
    """Rows (key, slot, cls, comp, n, sig, left, within) of the tasks that compare the members of open keys.

    A task compares a key's left rows with its others and, where within is set, with
    each other. Rows outside the key's main component are left somewhere. Small keys
    share a task, by their hash; large ones are split in blocks.
    """
    # With the signatures at once: the members of hot keys are joined with nothing else.
    rows = key_rows(members, with_sig=True).join(keys.drop("rows", "bytes").hint("merge"), KEY).withColumn("own", F.col("comp") != F.col("main"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(tasks)))
    spot = F.pmod(F.xxhash64("cls"), F.when(F.col("own"), F.col("out_blocks")).otherwise(F.col("main_blocks"))).cast("int")
    rows = rows.withColumn("spot", spot)
    # An outside row meets all outside blocks and all blocks of the main component; a row of that, the outside blocks.
    everywhere = F.expr(
        """
        CASE WHEN small THEN array(struct(bucket AS at, -1 AS i, -1 AS j, false AS with_main, own AS left, true AS within))
          WHEN own THEN concat(
            transform(sequence(0, out_blocks - 1), x -> struct(
              key AS at, least(x, spot) AS i, greatest(x, spot) AS j, false AS with_main, x >= spot AS left, x = spot AS within)),
            transform(sequence(0, main_blocks - 1), x -> struct(
              key AS at, spot AS i, x AS j, true AS with_main, true AS left, false AS within)))
          ELSE transform(sequence(0, out_blocks - 1), x -> struct(
              key AS at, x AS i, spot AS j, true AS with_main, false AS left, false AS within)) END
        """
    )
    tasked = rows.select(*KEY, "cls", "comp", "n", "sig", F.explode(everywhere).alias("t"))
    return tasked.select(*KEY, "cls", "comp", "n", "sig", *[F.col(f"t.{c}").alias(c) for c in (*TASK, "left", "within")])


def near_in_key(rows: pd.DataFrame, percent: int, farthest: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places to compare: a left row and the others that may be similar to it, of one key and of other components.

    A pair that has an earlier key, too, is left to that.
    """
    sig = _read_signatures(rows["sig"])
    comp, n, left, within = (rows[c].to_numpy() for c in ("comp", "n", "left", "within"))
    chunk, gone = divmod(int(rows["slot"].iat[0]), PER_CHUNK)
    place = np.arange(len(rows))
    for i in np.flatnonzero(left):
        # The larger set can't be larger than 100 / percent of the smaller one.
        at = (comp != comp[i]) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i]))
        at = np.flatnonzero(at & (~left | (within & (place > i))))
        errors = (sig[at] != sig[i]).reshape(len(at), sig.shape[1] // PER_CHUNK, PER_CHUNK).sum(2)
        here = (errors[:, chunk] == 1) | ((errors[:, chunk] == 0) & (gone == 0))
        at = at[here & (errors.sum(1) <= farthest) & (errors[:, :chunk] > 1).all(1)]
        if len(at):
            yield int(i), at


def missed_links(rows: pd.DataFrame, percent: int, farthest: int) -> list[tuple[int, int]]:
    """Links that join components, as their names, of a task's rows with their sets."""
    parent = {int(c): int(c) for c in rows["comp"].unique()}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    out = []
    for _, of_key in rows.groupby(KEY, sort=False):
        comp, sizes = (of_key[c].to_numpy() for c in ("comp", "n"))
        sets = [np.frombuffer(x, np.uint64) for x in of_key["elements"]]
        for i, at in near_in_key(of_key, percent, farthest):
            mine = root(int(comp[i]))
            at = at[[root(int(c)) != mine for c in comp[at]]]
            if not len(at):
                continue
            flat = np.concatenate([sets[j] for j in at])
            spots = np.minimum(np.searchsorted(sets[i], flat), sizes[i] - 1)
            hits = np.add.reduceat((sets[i][spots] == flat).astype(np.int64), np.cumsum(sizes[at]) - sizes[at])
            for j in at[100 * hits >= percent * (sizes[at] + sizes[i] - hits)]:
                a, b = root(int(comp[i])), root(int(comp[j]))
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    out.append((int(comp[i]), int(comp[j])))
    return out


def remaining_links(members: DataFrame, percent: int, farthest: int, block: int, scratch: Scratch) -> DataFrame | None:
    """Step 3 over (cls, comp, n, sig, elements): links (a, b) of different components, by name; None if no key has several."""
    keys = scratch.write(open_keys(members, block))
    if keys.isEmpty():
        return None
    large, few, fewer = keys.where(~F.col("small")).select(*KEY), keys.where("small"), None
    if not large.isEmpty():
        crowd = key_rows(members).join(large.hint("merge"), KEY).select("cls").distinct()
        crowd = scratch.write(members.join(crowd.hint("merge"), "cls"))
        alive = may_be_similar(crowd, percent, scratch)
        fewer = scratch.write(crowd.join(alive.hint("merge"), "cls"))
        again = scratch.write(open_keys(fewer, block).join(large.hint("merge"), KEY, "left_semi"))
        keys = few.unionByName(again)
    small = F.col("small")
    total = keys.agg(F.sum(F.when(small, F.col("rows"))), F.sum(F.when(small, F.col("bytes")))).first()
    tasks = max(1, -(-(total[0] or 0) // (2 * block)), -(-(total[1] or 0) // BLOCK_BYTES))
    tasked = key_tasks(members, few, tasks)
    if fewer is not None:
        tasked = tasked.unionByName(key_tasks(fewer, again, tasks))

    def needed(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, rows in group.groupby(KEY, sort=False):
            used = np.zeros(len(rows), dtype=bool)
            for i, at in near_in_key(rows, percent, farthest):
                used[i] = True
                used[at] = True
            out.append(rows[used])
        return pd.concat(out)[[*TASK, *KEY, "cls", "comp", "n", "left", "within"]]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(missed_links(group, percent, farthest), columns=["a", "b"], dtype="int64")

    sets = members.select("cls", "sig", "elements")
    shape = "at long, i int, j int, with_main boolean, key long, slot int, cls long, comp long, n long, left boolean, within boolean"
    used = scratch.write(tasked.groupBy(*TASK).applyInPandas(needed, shape))
    return scratch.write(used.join(sets.hint("merge"), "cls").groupBy(*TASK).applyInPandas(run, "a long, b long"))


def shingle_counts(sets: DataFrame, scratch: Scratch) -> np.ndarray:
    """How often shingles occur in sets (elements), added up in COUNTERS counters by their leading bits: a table of fixed size."""
    parts = 64
    each = COUNTERS // parts

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            total += np.bincount(_counter(np.frombuffer(b"".join(batch["elements"]), np.uint64)), minlength=COUNTERS)
        yield pd.DataFrame({"part": np.arange(parts, dtype=np.int32), "counts": [total[k * each : (k + 1) * each].tobytes() for k in range(parts)]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int64) for x in group["counts"])
        return pd.DataFrame({"part": group["part"].iloc[:1], "counts": [total.tobytes()]})

    counted = sets.select("elements").mapInPandas(count, "part int, counts binary").groupBy("part").applyInPandas(add, "part int, counts binary")
    rows = sorted(scratch.write(counted).collect())  # COUNTERS numbers, whatever the input
    return np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows]) if rows else np.zeros(COUNTERS, np.int64)


def _counter(elements: np.ndarray) -> np.ndarray:
    return (elements >> np.uint64(64 - (COUNTERS.bit_length() - 1))).astype(np.int64)


def prefix_lengths(n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of a set's first shingles a similar one that is no smaller, and one that is no larger, must have one of."""
    return n + 1 + (-2 * percent * n) // (100 + percent), n + 1 + (-percent * n) // 100


def may_be_similar(sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(cls) of the sets (cls, comp, n, elements) that a set of another component can be similar to.

    Sets are put in one order, rare shingles first. Of two similar sets the smaller
    one's first shingles and the larger one's (a few more) have one in common, so
    a set that shares none of these has no partner. Shingles' rows are summed by
    component first, so a shingle that all have costs a row a component and task.
    """
    counts = shingle_counts(sets, scratch)

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [np.frombuffer(x, np.uint64) for x in batch["elements"]]
            n = np.array([len(x) for x in sets])
            short, long_ = prefix_lengths(n, percent)
            first = [x[np.lexsort((x, counts[_counter(x)]))[:k]] for x, k in zip(sets, long_, strict=True)]
            place = np.concatenate([np.arange(k) for k in long_])
            of = np.repeat(np.arange(len(n)), long_)
            cls, comp = (batch[c].to_numpy()[of] for c in ("cls", "comp"))
            yield pd.DataFrame({"shingle": np.concatenate(first).view(np.int64), "cls": cls, "comp": comp, "indexed": place < short[of]})

    rows = scratch.write(sets.select("cls", "comp", "elements").mapInPandas(prefixes, "shingle long, cls long, comp long, indexed boolean"))
    indexed = F.when(F.col("indexed"), F.col("comp"))
    shared = rows.groupBy("shingle").agg(
        F.min("comp").alias("least"), F.max("comp").alias("most"), F.min(indexed).alias("ix_least"), F.max(indexed).alias("ix_most")
    )
    shared = scratch.write(shared.where("least <> most and ix_least is not null").drop("least", "most"))
    partner = F.col("indexed") | (F.col("ix_least") != F.col("comp")) | (F.col("ix_most") != F.col("comp"))
    return rows.join(shared.hint("merge"), "shingle").where(partner).select("cls").distinct()


def class_sets(rows: DataFrame, classes: DataFrame, links: DataFrame, words: int, scratch: Scratch) -> DataFrame:
    """(cls, n, sig, elements) of the linked classes: their sets, made again from the first row of each."""
    met = links.select(F.col("a").alias("cls")).union(links.select("b")).distinct()
    wanted = classes.select("cls", "n", "id", "h", "sig").join(met.hint("merge"), "cls")
    wanted = scratch.write(wanted.select("cls", "n", F.col("id").alias("first_id"), F.col("h").alias("first_h"), "sig"))
    found = rows.join(wanted.hint("merge"), rows["id"].eqNullSafe(wanted["first_id"]) & (rows["h"] == wanted["first_h"]), "inner")

    def elements(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = WordHashes()
        for batch in batches:
            sets = [shingles(bytes(x), words, memory).tobytes() for x in batch["body"]]
            yield pd.DataFrame({"cls": batch["cls"], "n": batch["n"], "sig": batch["sig"], "elements": sets})

    sets = found.select("cls", "n", "sig", "body").mapInPandas(elements, "cls long, n long, sig binary, elements binary")
    return scratch.write(sets.dropDuplicates(["cls"]))


def near_duplicates(
    docs: DataFrame,
    percent: int = 75,
    words: int = 5,
    chunks: int = 10,
    farthest: int = 25,
    block: int = 500,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Id, n_shingles, component_id, kept and text_hash (Spark's xxhash64 of the text) of every row.

    Documents are linked whose sets of distinct shingles have a Jaccard similarity
    of percent or more; a component's rows are those linked directly or through
    others, and its smallest id is kept. Texts without words have no shingles and
    are linked with nothing. Null texts count as empty. A null id is its own
    component (null) unless it is linked, counts as larger than any other, and is
    kept only if its component has no other id. Rows that repeat an id are all
    marked alike by text. An empty table gives an empty result; other columns are
    ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dedup")
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.cast("binary").alias("body"))
    told = scratch.write(sketch(rows, words, chunks))
    same = ["c1", "c2", "n"]
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("first")
    classes = told.where("n > 0").groupBy(*same).agg(first, F.first("sig").alias("sig"))
    # Written, the numbers are fixed; a null id comes last.
    classes = scratch.write(
        classes.select(
            F.monotonically_increasing_id().alias("cls"), *same, F.col("first.id").alias("id"), F.col("first.h").alias("h"),
            F.coalesce("first.id", F.lit(_LAST)).alias("order"), "sig",
        )
    )
    links = key_links(classes, scratch, bucket_bits(classes.count() * chunks * PER_CHUNK))
    comps = links.select(F.col("b").alias("node"), F.col("a").alias("label")).limit(0)
    if not links.isEmpty():
        sets = class_sets(rows, classes, links, words, scratch)
        best = links.groupBy("b").agg(F.min(F.struct("a_order", "a")).alias("best")).select("b", F.col("best.a").alias("a"))
        comps = components(confirmed(best, sets, percent), scratch)
        apart = with_comp(with_comp(links, comps, "a", "a_comp"), comps, "b", "b_comp").where("a_comp <> b_comp")
        apart = apart.join(best.hint("merge"), ["a", "b"], "left_anti").select("a", "b", "a_comp", "b_comp")
        more = scratch.write(confirmed(apart, sets, percent))
        if not more.isEmpty():
            comps = merged(comps, more.select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b")), scratch)
        members = scratch.write(with_comp(sets, comps))
        missed = remaining_links(members, percent, farthest, block, scratch)
        if missed is not None and not missed.isEmpty():
            comps = merged(comps, missed, scratch)
    named = with_comp(classes.select("cls", *same, "id"), comps)
    heads = named.groupBy("comp").agg(F.min("id").alias("head"))
    heads = scratch.write(named.join(heads.hint("merge"), "comp").select(*same, "head"))
    scratch.keep_only(told, heads)
    out = told.select("id", "h", *same).join(heads.hint("merge"), same, "left")
    component = F.when(F.col("n") > 0, F.col("head")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
        F.col("h").alias("text_hash"),
    )


def op8_near_dedup(spark, sf_dir):
    out = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


OP8_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
      lambda x: x <> '') AS words FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(words[s:s + 4], ' ') AS sh
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS s FROM docs WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM sets x JOIN sets y ON x.sh = y.sh AND x.doc_id <> y.doc_id
  JOIN sizes m ON m.doc_id = x.doc_id JOIN sizes k ON k.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, m.n, k.n HAVING 100 * count(*) >= 75 * (m.n + k.n - count(*))
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT d.doc_id, coalesce(max(n), 0) AS n_shingles, min(r.other) AS component_id, d.doc_id = min(r.other) AS kept
FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""
