"""Byte-level BPE in batches: merge rounds over flat numpy arrays.

A batch of texts is cut into words by the tokenizer's own pattern. Words not met
before are laid end to end in one flat array of symbols, and every round merges,
in all words at once, the pairs that have the lowest rank of their word. A pair's
rank is found by binary search over the sorted pair keys. Decoding gathers the
bytes of all ids of a batch from one flat byte table.

Texts are worked through in slices that end between words, so a task holds a few
MB whatever the length of a text (an unbroken run of letters, which is one word,
is held whole), and the word memory is bounded and dropped when
full (a later word is then just merged again).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import frugal_batches, table, text_or_empty

#: White space as the tokenizer's pattern means it (Unicode White_Space), fixed values.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters and digits of newer versions of Unicode than the tokenizers library knows (16), fixed values.
LATER = (
    r"\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f"
    r"\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2"
    r"\ua7f1\uab6c-\uab6d\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee"
    r"\U00011b0a\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f"
    r"\U00012550-\U00012686\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    r"\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168"
    r"\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    r"\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f"
    r"\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
LETTER, DIGIT = rf"[\p{{L}}--[{LATER}]]", rf"[\p{{N}}--[{LATER}]]"
#: The tokenizer's published word pattern, fixed value.
WORD = regex.compile(
    rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?{LETTER}+| ?{DIGIT}+| ?[^{SPACE}{LETTER}{DIGIT}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
#: No word holds white space after something else, so a text may be cut there.
PIECE = regex.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: Nor does one go on after letters, or after digits, with anything else but these.
CUT = regex.compile(rf"(?V1)[^{SPACE}](?=[{SPACE}])|{LETTER}(?!{LETTER})|{DIGIT}(?!{DIGIT})")
SLICE_CHARS = 1 << 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


def _ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The positions start..start+len-1 of every range, end to end."""
    ends = np.cumsum(lens)
    out = np.arange(ends[-1] if len(ends) else 0, dtype=np.int64)
    return out + np.repeat(starts - (ends - lens), lens)


class ByteBpe:
    """A byte-level BPE vocabulary, loaded from a tokenizer's JSON file."""

    def __init__(self, path: str, memory_words: int = 1_000_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        symbols = byte_symbols()
        to_byte = {c: b for b, c in enumerate(symbols)}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.byte_id = np.array([vocab[c] for c in symbols], dtype=np.int64)
        self.base = 1 + max([*vocab.values(), *self.special.values()])
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], dtype=np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks, self.pair_ids = keys[order], order.astype(np.int64), merged[order]
        strings = [b""] * self.base
        for token, i in vocab.items():
            strings[i] = bytes(to_byte[c] for c in token)
        for token, i in self.special.items():
            strings[i] = token.encode()
        self.table, self.table_at, self.table_len = self._flat(strings)
        self.digits, self.digits_at, self.digits_len = self._flat([b"%d," % i for i in range(self.base)])
        self.splitter = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")") if self.special else None
        self.memory_words = memory_words
        self._forget()

    @staticmethod
    def _flat(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lens = np.array([len(s) for s in strings], dtype=np.int64)
        return np.frombuffer(b"".join(strings), dtype=np.uint8), np.cumsum(lens) - lens, lens

    def _forget(self) -> None:
        """Start an empty memory: pieces by number, and the ids of each number."""
        self.memory: dict[str, int] = {}
        self.ids = np.empty(1 << 20, dtype=np.int32)
        self.at = np.zeros(1 << 16, dtype=np.int64)
        self.n_ids = 0
        for token, i in self.special.items():
            self.memory[token] = self.n_ids
            self.ids[self.n_ids] = i
            self.n_ids += 1
            self.at[self.n_ids] = self.n_ids

    def _remember(self, pieces: list[str]) -> None:
        words = [WORD.findall(p) for p in pieces]
        flat = [w for ws in words for w in ws]
        distinct = list(dict.fromkeys(flat))
        ids, counts = self.merge([w.encode() for w in distinct])
        number = {w: i for i, w in enumerate(distinct)}
        which = np.fromiter((number[w] for w in flat), dtype=np.int64, count=len(flat))
        starts = np.cumsum(counts) - counts
        n_of_word = counts[which]
        new = ids[_ranges(starts[which], n_of_word)]
        of_piece = np.repeat(np.arange(len(pieces)), [len(ws) for ws in words])
        n_of_piece = np.bincount(of_piece, weights=n_of_word, minlength=len(pieces)).astype(np.int64)
        first = len(self.memory)
        while self.n_ids + len(new) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while first + len(pieces) + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.ids[self.n_ids : self.n_ids + len(new)] = new
        self.at[first + 1 : first + 1 + len(pieces)] = self.n_ids + np.cumsum(n_of_piece)
        self.n_ids += len(new)
        self.memory.update(zip(pieces, range(first, first + len(pieces)), strict=True))

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and how many each has."""
        n_words = len(words)
        lens = np.array([len(w) for w in words], dtype=np.int64)
        ids = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(n_words), lens)
        none = np.iinfo(np.int64).max

        def looked_up(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Rank and merged id of the pairs that begin at some places; no pair crosses words."""
            after = np.minimum(at + 1, len(ids) - 1)
            keys = ids[at] * self.base + ids[after]
            found = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            ok = (self.pair_keys[found] == keys) & (word[at] == word[after]) & (after > at)
            return np.where(ok, self.pair_ranks[found], none), self.pair_ids[found]

        done_ids, done_words = [], []
        rank, into = looked_up(np.arange(len(ids)))
        while len(ids):
            begins = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, begins)
            sizes = np.diff(np.append(begins, len(ids)))
            live = np.repeat(best < none, sizes)
            if not live.all():  # words in which nothing merges any more
                done_ids.append(ids[~live])
                done_words.append(word[~live])
                if not live.any():
                    break
            hit = (rank == np.repeat(best, sizes)) & live
            # Of overlapping pairs (a a a) the left one goes first: every second of a run.
            if (hit[1:] & hit[:-1]).any():
                where = np.flatnonzero(hit)
                head = np.append(True, np.diff(where) > 1)
                run = np.maximum.accumulate(np.where(head, np.arange(len(where)), 0))
                hit[where[(np.arange(len(where)) - run) % 2 == 1]] = False
            left = np.flatnonzero(hit)
            ids[left] = into[left]
            live[left + 1] = False
            moved = (np.cumsum(live) - 1)[left]
            ids, word, rank, into = ids[live], word[live], rank[live], into[live]
            # Only the pairs that a merged symbol is part of have changed.
            changed = np.unique(np.concatenate([moved, np.maximum(moved - 1, 0)]))
            rank[changed], into[changed] = looked_up(changed)
        if not done_ids:
            return np.empty(0, np.int32), np.zeros(n_words, np.int64)
        all_ids, all_words = np.concatenate(done_ids), np.concatenate(done_words)
        order = np.argsort(all_words, kind="stable")
        return all_ids[order].astype(np.int32), np.bincount(all_words, minlength=n_words)

    def _pieces(self, text: str) -> list[str]:
        """What lies between special tokens in pieces, and these tokens themselves."""
        if not self.splitter:
            return PIECE.findall(text)
        parts = self.splitter.split(text)
        out = PIECE.findall(parts[0])
        for token, part in zip(parts[1::2], parts[2::2], strict=True):
            out.append(token)
            out += PIECE.findall(part)
        return out

    def slices(self, text: str) -> Iterator[str]:
        """A long text in parts, cut where a word of the pattern ends, in no special token.

        Only an unbroken run of letters, of digits or of other characters is never cut.
        """
        longest = max(map(len, self.special), default=0)
        at = 0
        while at < len(text):
            end = min(at + SLICE_CHARS, len(text))
            while end < len(text):
                cut = CUT.search(text, end - 1)
                end = cut.end() if cut else len(text)
                near = max(at, end - longest)
                over = [m for m in self.splitter.finditer(text, near, end + longest) if m.start() < end < m.end()] if longest else []
                if not over:
                    break
                end = over[0].end()
            yield text[at:end]
            at = end

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has; unseen words of all are merged together."""
        pieces: list[str] = []
        ends = []
        for text in texts:
            pieces += self._pieces(text)
            ends.append(len(pieces))
        if not pieces:
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        unseen = [p for p in set(pieces) if p not in self.memory]
        if unseen:
            if len(self.memory) + len(unseen) > self.memory_words:
                self._forget()
                unseen = [p for p in set(pieces) if p not in self.memory]
            self._remember(unseen)
        which = np.fromiter(map(self.memory.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        n = self.at[which + 1] - self.at[which]
        total = np.append(0, np.cumsum(n))[np.array([0, *ends])]
        return self.ids[_ranges(self.at[which], n)], np.diff(total)

    def encode(self, text: str) -> np.ndarray:
        return np.concatenate([np.empty(0, np.int32), *(self.encode_many([part])[0] for part in self.slices(text))])

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return self.table[_ranges(self.table_at[ids], self.table_len[ids])].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, each followed by a comma."""
        return self.digits[_ranges(self.digits_at[ids], self.digits_len[ids])].tobytes()

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """For every text: how many ids, the digest of these, and of the text decoded from them."""
        ids, counts = self.encode_many(texts)
        numbers, decoded = self.decimal(ids), self.decode_bytes(ids)
        ends = np.cumsum(counts)
        number_ends = np.append(0, np.cumsum(self.digits_len[ids]))[ends].tolist()
        byte_ends = np.append(0, np.cumsum(self.table_len[ids]))[ends].tolist()
        out, a, b = [], 0, 0
        for n, x, y in zip(counts.tolist(), number_ends, byte_ends, strict=True):
            said = numbers[a : max(a, x - 1)]
            out.append((n, hashlib.sha256(said).hexdigest(), hashlib.sha256(decoded[b:y]).hexdigest()))
            a, b = x, y
        return out

    def long_digests(self, text: str) -> tuple[int, str, str]:
        """The same for a text that is worked through slice by slice."""
        n, ids_sha, text_sha, held = 0, hashlib.sha256(), hashlib.sha256(), b""
        for part in self.slices(text):
            ids = self.encode_many([part])[0]
            n += len(ids)
            digits = held + self.decimal(ids)
            ids_sha.update(digits[:-1])
            held = digits[-1:]
            text_sha.update(self.decode_bytes(ids))
        return n, ids_sha.hexdigest(), text_sha.hexdigest()


_loaded: dict[str, ByteBpe] = {}


def load(path: str) -> ByteBpe:
    """The vocabulary at path, once for each Python worker."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of SLICE_CHARS in all, or of a single longer one."""
    at, held = 0, 0
    for k, text in enumerate(texts):
        if k > at and held + len(text) > SLICE_CHARS:
            yield at, k
            at, held = k, 0
        held += len(text)
    if at < len(texts):
        yield at, len(texts)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: str | None = None) -> DataFrame:
    """id and ids (array of int) of every row, with the special token end, if given, after each; a null text has none, a null id stays null."""

    @frugal_batches
    def run(batches):
        bpe = load(path)
        last = [] if end is None else [bpe.special[end]]
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in _groups(texts):
                if b - a == 1:
                    each = [bpe.encode(texts[a])]
                else:
                    ids, counts = bpe.encode_many(texts[a:b])
                    each = np.split(ids, np.cumsum(counts)[:-1])
                yield pd.DataFrame({id_col: batch["id"].iloc[a:b], "ids": [np.append(x, last).astype(np.int32) for x in each]})
        bpe._forget()  # the worker lives on, and its next task may be another stage's

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInPandas(run, f"`{id_col}` {kind}, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and decoded text of every row of ids; null ids give an empty text.

    Bytes that are no UTF-8 become U+FFFD.
    """

    def run(batches):
        bpe = load(path)
        for batch in batches:
            texts = ["" if x is None else bpe.decode(np.asarray(x, dtype=np.int64)) for x in batch["ids"]]
            yield pd.DataFrame({id_col: batch["id"], "text": texts})

    kind = encoded.schema[id_col].dataType.simpleString()
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInPandas(run, f"`{id_col}` {kind}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 of every row, in one pass over its text.

    Null texts count as empty (no tokens, digests of nothing); null ids, repeated
    rows and further columns need no care, as rows are worked on one by one. The
    digests are fed slice by slice, so no text is held as ids as a whole.
    """

    def run(batches):
        bpe = load(path)
        for batch in batches:
            out: list[tuple[int, str, str]] = []
            texts = batch["text"].tolist()
            for a, b in _groups(texts):
                out += [bpe.long_digests(texts[a])] if b - a == 1 and len(texts[a]) > SLICE_CHARS else bpe.digests(texts[a:b])
            yield pd.DataFrame(
                {
                    id_col: batch["id"],
                    "n_tokens": pd.Series([x[0] for x in out], dtype="int64"),
                    "ids_sha256": [x[1] for x in out],
                    "decoded_sha256": [x[2] for x in out],
                }
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInPandas(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


#: The vocabulary's token for the end of a text, fixed value.
END = "<|endoftext|>"


def installed() -> str:
    """The 50k byte-level vocabulary of the installed tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_bpe(spark, sf_dir, path: str | None = None):
    """Production parameters: the installed 50k byte-level vocabulary."""
    return round_trip(table(spark, sf_dir, "documents"), path or installed())
