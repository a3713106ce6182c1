"""Substring deduplication over windows of words, by Rabin-Karp hashes.

Every window of ``width`` consecutive words of a document has a rolling hash of
its words' 64-bit hashes. All windows are counted in Spark (see blocks.py), each
document learns which of its windows start earlier in the corpus, and these merge
into maximal intervals of words to remove.

Windows are equal when 96 bits of two hashes are; among n different windows some
n**2 / 2**97 pairs are taken for equal by chance, and words as 64-bit hashes by theirs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.blocks import Block, bucket_bits, ordered_blocks, read_answers, seen_earlier, with_answers
from textmill.llm.common import Scratch, frugal_batches, table
from textmill.llm.hashing import WordHashes, mixed, windows

_SECOND = np.uint64(0xA0761D6478BD642F)


def _words(block: Block) -> tuple[list[bytes], np.ndarray]:
    """All words of a block and the number of each document's (bytes.split() parts at ASCII blanks)."""
    words: list[bytes] = []
    counts = []
    for text in block.texts():
        own = text.split()
        counts.append(len(own))
        words += own
    return words, np.array(counts, np.int64)


def _window_starts(counts: np.ndarray, width: int) -> np.ndarray:
    """Positions at which a window lies within one document."""
    ends = np.cumsum(counts)
    at = np.arange(int(ends[-1]) if len(ends) else 0)
    return at[at + width <= np.repeat(ends, counts)]


def _hashes(block: Block, width: int, memory: WordHashes) -> tuple[list[bytes], np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Words, the number of each document's, where windows start, and their hashes: 64 bits, and 32 of another one."""
    words, counts = _words(block)
    starts = _window_starts(counts, width)
    if not len(starts):
        return words, counts, starts, (np.empty(0, np.uint64), np.empty(0, np.uint32))
    own = memory.of(words)
    further = (windows(mixed(own ^ _SECOND), width)[starts] >> np.uint64(32)).astype(np.uint32)
    return words, counts, starts, (windows(own, width)[starts], further)


def intervals(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the maximal runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], covered.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def dedup_windows(
    docs: DataFrame, width: int = 20, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """Id, n_words, n_removed, spans, kept_sha256 (and kept, the text left) of every row.

    A word goes if a window over it also starts earlier: in a smaller id, or
    before in the same document. spans are the removed intervals of words, from
    and to (exclusive). Words are runs of anything but ASCII blanks; what is kept
    is joined by single spaces. A null text has no words; a null id is smaller
    than any other, and rows of one id go by their text, each later one counting
    as later; equal rows are told apart by their order. An empty table gives an
    empty result; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "substring-dedup")
    blocks, total = ordered_blocks(docs, scratch, id_col, text_col, split_ids=True)

    def hashes():
        memory = WordHashes()
        return lambda row: _hashes(Block(row), width, memory)[-1]

    told = seen_earlier(blocks, hashes(), bucket_bits(total // 6), scratch, more=True)

    @frugal_batches
    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = WordHashes()
        for batch in batches:
            for row in batch.itertuples(index=False):
                block = Block(row)
                words, counts, starts, (found, further) = _hashes(block, width, memory)
                covered = np.zeros(len(words) + 1, dtype=np.int32)
                if len(found):
                    _, first, which = np.unique(found, return_index=True, return_inverse=True)
                    earlier = read_answers(row.told)[which]
                    earlier |= first[which] != np.arange(len(found))
                    earlier &= further == further[first][which]
                    np.add.at(covered, starts[earlier], 1)
                    np.add.at(covered, starts[earlier] + width, -1)
                gone = np.cumsum(covered)[:-1] > 0
                out, at = [], 0
                for i, n in enumerate(counts):
                    own, lost = words[at : at + n], gone[at : at + n]
                    n_lost = int(lost.sum())
                    left = b" ".join([w for w, x in zip(own, lost, strict=True) if not x] if n_lost else own)
                    a, b = intervals(lost)
                    spans = [{"begin": int(x), "end": int(y)} for x, y in zip(a, b, strict=True)]
                    line = (block.id_of(i), int(n), n_lost, spans, hashlib.sha256(left).hexdigest())
                    out.append((*line, left.decode()) if with_text else line)
                    at += n
                names = ["id", "n_words", "n_removed", "spans", "kept_sha256", *["kept"] * with_text]
                yield pd.DataFrame(out, columns=names).astype({"id": "Int64"})

    shape = "id long, n_words long, n_removed long, spans array<struct<begin: long, end: long>>, kept_sha256 string"
    out = with_answers(blocks, told).mapInPandas(remove, shape + ", kept string" * with_text)
    return out.withColumnRenamed("id", id_col)


def op9_substring_dedup(spark, sf_dir):
    out = dedup_windows(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


OP9_SQL = r"""
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), keyed AS MATERIALIZED (
  SELECT doc_id, unnest(range(1, len(words) - 18)) AS s,
         unnest(list_transform(range(1, len(words) - 18), lambda i: md5_number(array_to_string(words[i:i + 19], ' ')))) AS w
  FROM docs WHERE len(words) >= 20
), win AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY w ORDER BY doc_id, s) AS k FROM keyed
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM win WHERE k > 1
), flat AS (
  SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS p FROM docs
), told AS (
  SELECT f.doc_id, count(*) AS n_words, count(g.p) AS n_removed,
         coalesce(string_agg(w, ' ' ORDER BY f.p) FILTER (g.p IS NULL), '') AS kept
  FROM flat f LEFT JOIN gone g ON f.doc_id = g.doc_id AND f.p = g.p GROUP BY f.doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs d LEFT JOIN told t ON d.doc_id = t.doc_id
"""
