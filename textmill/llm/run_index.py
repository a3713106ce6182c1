"""A run-length index: run-compressed Burrows-Wheeler transform with sampled run ends."""

from __future__ import annotations

import numpy as np


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of keys, and the number of each one's value in it."""
    order = np.argsort(keys)
    ordered = keys[order]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(np.append(0, ordered[1:] != ordered[:-1]))
    return order, rank


def _group_starts(order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """rank, renamed: a suffix's rank is the place in order at which its group of equals begins."""
    ranks = rank[order]
    begins = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1]))
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(begins, np.diff(np.append(begins, len(order))))
    return out


#: Symbols that one packed word of the suffix sort holds, at 9 bits each.
PACKED = 7
#: Symbols that are compared at a time.
WORD = 4


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The suffixes of a text of symbols up to 256, sorted, by doubling over groups of equal beginnings."""
    n = len(text)
    padded = np.append(text, np.zeros(PACKED, np.int64))
    word = np.zeros(n, np.int64)
    for k in range(PACKED):
        word = (word << 9) | padded[k : k + n]
    order, rank = _dense(word)
    rank = _group_starts(order, rank)
    span = PACKED
    while True:
        # Only groups of several suffixes are sorted on, each within its own places.
        ranks = rank[order]
        alone = np.append(ranks[1:] != ranks[:-1], True) & np.append(True, ranks[1:] != ranks[:-1])
        places = np.flatnonzero(~alone)
        if not len(places) or span >= 2 * n:
            return order
        members = order[places]
        ahead = members + span
        behind = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        keys = rank[members] * (n + 1) + behind
        sorted_ = np.argsort(keys)
        members, keys = members[sorted_], keys[sorted_]
        order[places] = members
        new = np.append(True, keys[1:] != keys[:-1])
        rank[members] = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        span *= 2


class RunIndex:
    """Index of a text of bytes that may hold separators.

    The text is an array of symbols 0 (separator, matched by nothing) to 256 (byte
    + 1). What is kept of the transform is its runs: their symbols, their starts,
    where the last-to-first mapping sends each start, and the suffix positions at
    both ends of each run; and the text itself, two bytes a symbol, to compare
    continuations up to ``most`` symbols. The suffix order is needed to build the
    runs only and is not kept.
    """

    def __init__(self, text: np.ndarray, most: int = 64):
        text = np.append(text.astype(np.int64), 0)
        n = len(text)
        self.most = most
        # Past the end there are separators; words of four symbols can be read from any place.
        self.text = np.zeros(n + most + WORD, np.uint16)
        self.text[:n] = text
        self.word = np.ndarray(len(self.text) - WORD + 1, np.dtype("<u8"), self.text, 0, (2,))
        order = suffix_order(text)
        last = text[order - 1]
        starts = np.flatnonzero(np.append(True, last[1:] != last[:-1]))
        lengths = np.diff(np.append(starts, n))
        self.starts = starts.astype(np.int32)
        self.heads = last[starts].astype(np.int32)
        self.ends = (starts + lengths - 1).astype(np.int32)
        self.sa_first = order[starts].astype(np.int32)
        self.sa_last = order[starts + lengths - 1].astype(np.int32)
        # Runs by symbol: the key of a run is its symbol and number.
        self.n_runs = len(starts)
        by_symbol = np.argsort(self.heads, kind="stable")
        self.keys = self.heads[by_symbol].astype(np.int64) * self.n_runs + by_symbol
        self.by_symbol = by_symbol
        below = np.cumsum(lengths[by_symbol]) - lengths[by_symbol]
        self.to = np.empty(self.n_runs, np.int32)
        self.to[by_symbol] = below  # symbols sort as the first column does

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes at a and b have in common, up to most."""
        a, b, out = a.astype(np.int64), b.astype(np.int64), np.zeros(len(a), np.int64)
        live = np.flatnonzero(most > 0)
        x, y = a[live], b[live]
        for k in range(0, self.most, WORD):
            differ = self.word[x] ^ self.word[y]
            same = differ == 0
            off = live[~same]
            differ = differ[~same]
            # The first symbol is the lowest.
            out[off] = k + ((differ & np.uint64(0xFFFF)) == 0).astype(np.int64) * (
                1 + ((differ & np.uint64(0xFFFFFFFF)) == 0) + ((differ & np.uint64(0xFFFFFFFFFFFF)) == 0)
            )
            out[live[same]] = k + WORD
            same[same] = most[live[same]] > k + WORD
            live = live[same]
            if not len(live):
                break
            x, y = a[live] + k + WORD, b[live] + k + WORD
        return np.minimum(out, most)

    def long_matches(self, body: np.ndarray, begins: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
        """Per byte of body: whether the longest match from there, inside a pattern, has width symbols or more.

        The patterns are body[begin : begin + size]; they may overlap. All are
        streamed side by side, from their ends. A pattern's row moves by the
        last-to-first mapping while its symbol is the row's; otherwise it goes to the
        nearer ends of the symbol's runs above and below, keeps the better
        continuation, and its text position is that run end's sample.
        """
        hit = np.zeros(len(body), dtype=bool)
        self._stream(body, begins, sizes, lambda at, length: hit.__setitem__(at[length >= width], True))
        return hit

    def matching_statistics(self, pattern: np.ndarray) -> np.ndarray:
        """The longest match, up to most, at every position of a pattern of bytes."""
        out = np.zeros(len(pattern), np.int64)
        self._stream(pattern, np.zeros(1, np.int64), np.array([len(pattern)]), out.__setitem__)
        return out

    def _stream(self, body: np.ndarray, begins: np.ndarray, sizes: np.ndarray, found) -> None:
        by_length = np.argsort(-sizes, kind="stable")
        sizes = sizes[by_length]
        ends = begins[by_length] + sizes
        n = len(sizes)
        row = np.zeros(n, np.int32)
        spot = np.full(n, self.sa_first[0], np.int32)
        length = np.zeros(n, np.int32)
        steps = int(sizes[0]) if n else 0
        live_at = np.searchsorted(-sizes, -np.arange(1, steps + 1), side="right")
        for t in range(steps):
            k = live_at[t]
            at = ends[:k] - (1 + t)
            symbol = body[at].astype(np.int32)
            symbol += 1
            q = row[:k]
            run = np.searchsorted(self.starts, q, side="right") - 1
            off = np.flatnonzero(self.heads[run] != symbol)
            lost = off[:0]
            if len(off):
                wanted = symbol[off]
                near = np.searchsorted(self.keys, wanted * np.int64(self.n_runs) + run[off])
                up = self.by_symbol[np.maximum(near - 1, 0)]
                down = self.by_symbol[np.minimum(near, self.n_runs - 1)]
                has_up = (near > 0) & (self.heads[up] == wanted)
                has_down = (near < self.n_runs) & (self.heads[down] == wanted)
                now, most = spot[off], length[off]
                by_up = np.where(has_up, self.common(now, self.sa_last[up], most), -1)
                by_down = np.where(has_down, self.common(now, self.sa_first[down], most), -1)
                go_up = by_up >= by_down
                kept = np.maximum(by_up, by_down)
                run[off] = np.where(go_up, up, down)
                q[off] = np.where(go_up, self.ends[up], self.starts[down])
                spot[off] = np.where(go_up, self.sa_last[up], self.sa_first[down])
                length[off] = kept
                lost = off[kept < 0]
            q += self.to[run] - self.starts[run]
            spot[:k] -= 1
            length[:k] += 1
            np.minimum(length[:k], self.most, out=length[:k])
            if len(lost):  # the text has no such symbol
                row[lost], spot[lost], length[lost] = 0, self.sa_first[0], 0
            found(at, length[:k])
