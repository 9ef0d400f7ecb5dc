"""A run-length index: the run-compressed Burrows-Wheeler transform of many segments, with samples at the ends of its runs.

The transform of repetitive text has few runs. The index keeps of each run its byte, its length, and the text positions of its first
and last row; sorting the suffixes, once, is the means to that and is not kept. count() searches backward by steps from run to run.
Matching statistics need no more than the samples: the match of a suffix with the row before is compared, byte by byte, where a run
begins, and with the row after where one ends. From there they are streamed over the text: a suffix whose row lies inside a run
has the neighbour of the suffix before it in the text, one further on, and matches one byte less.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_PACK = 8


class RunLengthIndex:
    """Index over segments of bytes below 255 (UTF-8 has none above 244). A segment ends with a mark of its own, smaller than
    any byte; marks order as their segments do, so no match crosses one.

    text: the segments' bytes, each one up, and 0 for marks. first: where each segment begins.
    heads, starts: byte and first row of each run. start_at, end_at: text positions of the rows that begin and end runs.
    """

    def __init__(self, segments: Sequence[bytes]) -> None:
        sizes = np.array([len(s) + 1 for s in segments])
        self.first = np.cumsum(sizes) - sizes
        raw = np.frombuffer(b"\xff".join(segments) + b"\xff", np.uint8)
        self.text = raw + np.uint8(1)
        n = len(raw)
        self.left = (np.repeat(self.first + sizes - 1, sizes) - np.arange(n)).astype(np.int32)  # bytes before the segment's mark
        self._pack()
        rows = self._sorted_suffixes()
        before = self.text[rows - 1]  # of the first suffix, the last mark
        begins = np.empty(n, bool)
        begins[0] = True
        begins[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        self.starts = np.flatnonzero(begins)
        self.heads = before[self.starts]
        self.start_at = rows[self.starts]
        self.end_at = rows[np.append(self.starts[1:], n) - 1]
        # for backward search: rows of smaller bytes, and of the same byte in runs before
        order = np.argsort(self.heads, kind="stable")
        lengths = np.diff(self.starts, append=n)
        self._run_rank = np.empty(len(order), np.int64)
        self._run_rank[order] = np.cumsum(lengths[order]) - lengths[order]
        self._by_byte = {int(b): np.flatnonzero(self.heads == b) for b in np.unique(self.heads)}
        self._base = np.searchsorted(np.sort(self.text), np.arange(257))

    def _rank(self, byte: int, row: int) -> int:
        """The row of the suffix that byte and the suffix of row give, were the byte before it: the step from run to run."""
        runs = self._by_byte[byte]
        k = int(np.searchsorted(self.starts[runs], row)) - 1  # the last of the byte's runs to begin before row
        if k < 0:
            return int(self._base[byte])
        run = runs[k]
        end = self.starts[run + 1] if run + 1 < len(self.starts) else len(self.text)
        return int(self._run_rank[run]) + min(row, int(end)) - int(self.starts[run])

    def count(self, pattern: bytes) -> int:
        """How often the pattern occurs in the segments, by backward search over the runs."""
        low, high = 0, len(self.text)
        for b in reversed(pattern):
            if b + 1 not in self._by_byte:
                return 0
            low, high = self._rank(b + 1, low), self._rank(b + 1, high)
            if low >= high:
                return 0
        return high - low

    def _pack(self) -> None:
        """Eight bytes from each position on in one number, with nothing after a mark."""
        n = len(self.text)
        wide = np.concatenate([self.text, np.zeros(_PACK, np.uint8)])
        key = np.zeros(n + _PACK, np.uint64)
        for k in range(_PACK):
            key[:n] = key[:n] << np.uint64(8) | wide[k : k + n]
        near = np.flatnonzero(self.left < _PACK)
        key[near] &= ~((np.uint64(1) << (8 * (_PACK - self.left[near])).astype(np.uint64)) - np.uint64(1)) & np.where(self.left[near] == 0, np.uint64(0), np.uint64(2**64 - 1))
        self.key = key

    def _sorted_suffixes(self) -> np.ndarray:
        """Rows of the suffix array, by doubling the length that is compared, for suffixes that are not yet told apart."""
        n = len(self.text)
        order = np.argsort(self.key[:n], kind="stable")
        sorted_key = self.key[order]
        new = np.empty(n, bool)
        new[0] = True
        new[1:] = (sorted_key[1:] != sorted_key[:-1]) | (self.left[order[1:]] < _PACK)
        head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank = np.empty(n, np.int64)
        rank[order] = head
        single = new & np.append(new[1:], True)
        rows, h = np.flatnonzero(~single), _PACK
        while len(rows):
            at = order[rows]
            pair = rank[at] << 32 | rank[at + h]
            turn = np.argsort(pair)
            pair, at = pair[turn], at[turn]
            order[rows] = at
            new = np.empty(len(rows), bool)
            new[0] = True
            new[1:] = pair[1:] != pair[:-1]
            head = np.maximum.accumulate(np.where(new, rows, 0))
            rank[at] = head
            rows = rows[~(new & np.append(new[1:], True))]
            h *= 2
        return order

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of the suffixes at a and b, within their segments."""
        out = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live] + out[live], b[live] + out[live]
            kx, ky = self.key[x], self.key[y]
            same = (kx == ky) & (self.left[x] >= _PACK) & (self.left[y] >= _PACK)
            done = live[~same]
            differ = kx[~same] ^ ky[~same]
            _, bits = np.frexp((differ >> np.uint64(11)).astype(np.float64))
            lead = np.where(differ >> np.uint64(11) > 0, (53 - bits) // 8, np.where(differ > 0, 6 + (differ < 256), _PACK))
            out[done] += np.minimum(lead, np.minimum(self.left[x[~same]], self.left[y[~same]]))
            live = live[same]
            out[live] += _PACK
        return out

    def _streamed(self, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Lengths at the text positions at, and from each of them on one less at every step until the next."""
        n = len(self.text)
        sampled, known = np.zeros(n, np.int64), np.zeros(n, bool)
        sampled[at] = lengths
        known[at] = True
        known[0] = True
        here = np.arange(n)
        last = np.maximum.accumulate(np.where(known, here, 0))
        return sampled[last] - (here - last)

    def matching(self) -> np.ndarray:
        """For each text position, the longest that it agrees with the suffix in the row before its own or in the row after."""
        lengths = self.common(self.start_at[1:], self.end_at[:-1])
        before = self._streamed(np.append(self.start_at[0], self.start_at[1:]), np.append(0, lengths))
        after = self._streamed(np.append(self.end_at[:-1], self.end_at[-1]), np.append(lengths, 0))
        return np.maximum(before, after)

    def repeated(self, length: int) -> np.ndarray:
        """Text positions from which length bytes also begin elsewhere in the segments, as true."""
        return self.matching() >= length


def repeated_starts(segments: Sequence[bytes], length: int) -> list[np.ndarray]:
    """For each segment, true at each start from which length bytes also begin elsewhere in the segments."""
    index = RunLengthIndex(segments)
    mark = index.repeated(length)
    return [mark[a : a + len(s)] for a, s in zip(index.first, segments, strict=True)]
