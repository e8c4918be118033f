"""An FM-index over a text of small integers: wavelet-tree ranks, sampled positions."""

from __future__ import annotations

import numpy as np

#: Every so many text positions one is kept for locating.
SAMPLE = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; only suffixes still tied are sorted again.

    A suffix that is a prefix of another comes first.
    """
    n = len(text)
    order = np.argsort(text, kind="stable")
    if n < 2:
        return order
    new = np.concatenate([[True], text[order[1:]] != text[order[:-1]]])
    head = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = head[np.cumsum(new) - 1]
    step = 1
    while len(head) < n:
        size = np.diff(np.append(head, n))
        tied = size > 1
        at = np.concatenate([[0], np.cumsum(size[tied])])
        places = np.repeat(head[tied] - at[:-1], size[tied]) + np.arange(at[-1])
        suffix = order[places]
        after = suffix + step
        key = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        group = rank[suffix]
        by = np.lexsort((key, group))
        suffix, key, group = suffix[by], key[by], group[by]
        order[places] = suffix
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])])
        first = places[new]
        rank[suffix] = first[np.cumsum(new) - 1]
        head = np.union1d(head, first)
        step *= 2
    return order


class WaveletTree:
    """Ranks of symbols in a sequence, by one bit row per level (wavelet matrix)."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        self.depth = max(1, int(n_symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        cur = np.asarray(seq)
        for level in range(self.depth - 1, -1, -1):
            bit = (cur >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(int(len(cur) - bit.sum()))
            cur = np.concatenate([cur[bit == 0], cur[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        lo, hi = np.zeros(len(at), np.int64), np.asarray(at, np.int64)
        for ones, zeros, level in zip(self.ones, self.zeros, range(self.depth - 1, -1, -1)):
            bit = ((symbol >> level) & 1).astype(bool)
            a, b = ones[lo], ones[hi]
            lo = np.where(bit, zeros + a, lo - a)
            hi = np.where(bit, zeros + b, hi - b)
        return hi - lo

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbols at the given places."""
        out, at = np.zeros(len(at), np.int64), np.asarray(at, np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            bit = ones[at + 1] - ones[at]
            out = out * 2 + bit
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
        return out


class FMIndex:
    """Backward search over ``text``, whose symbols are 1 .. n_symbols - 1."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        text = np.append(np.asarray(text, np.int64), 0)  # the end sorts before all
        order = suffix_array(text)
        last = text[order - 1]
        self.tree = WaveletTree(last, n_symbols)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        kept = order % SAMPLE == 0
        self.kept_rank = np.concatenate([[0], np.cumsum(kept)])
        self.kept = kept
        self.position = order[kept]

    def search(self, patterns: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of all patterns (rows, right-aligned in the matrix, 0 before)."""
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), self.start[-1], np.int64)
        live = np.arange(len(patterns))
        for back in range(patterns.shape[1] if len(patterns) else 0):
            live = live[(length[live] > back) & (hi[live] > lo[live])]
            if not len(live):
                break
            symbol = patterns[live, patterns.shape[1] - 1 - back]
            rank = self.tree.rank(np.tile(symbol, 2), np.concatenate([lo[live], hi[live]]))
            base = self.start[symbol]
            lo[live], hi[live] = base + rank[: len(live)], base + rank[len(live):]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back to the next sampled one."""
        at, steps, out = rows.copy(), 0, np.empty(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            here = self.kept[at]
            out[todo[here]] = self.position[self.kept_rank[at[here]]] + steps
            todo, at = todo[~here], at[~here]
            if len(todo):
                symbol = self.tree.access(at)
                at = self.start[symbol] + self.tree.rank(symbol, at)
                steps += 1
        return out
