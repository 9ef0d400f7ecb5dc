"""Hashes of windows of words or bytes, a text at a time, from prefix sums.

The fingerprint of bytes b[i:j] is the sum of (b[k] + 1) * B ^ (k - i) modulo the prime 2 ^ 61 - 1, for a random B: a polynomial,
which two different strings of n bytes share for n of all 2 ^ 61 B at most. (Modulo a power of two some strings agree for every
B.) Prefix sums give it for any window in a few operations, wherever the window stands. What must be equal for certain is compared
by digest128(), a cryptographic digest of the bytes themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np

#: A-Z to a-z, and no other letters.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Bytes hashed at once, and words of a piece of a long text.
CHUNK_BYTES, PIECE_WORDS = 1 << 19, 50_000
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: The prime, and masks of the low bits that products are put together from.
PRIME = (1 << 61) - 1
_P, _U30, _U31, _U61 = np.uint64(PRIME), np.uint64(30), np.uint64(31), np.uint64(61)
_LOW30, _LOW31 = np.uint64((1 << 30) - 1), np.uint64((1 << 31) - 1)
#: Sums of so many bytes fit 64 bits.
LONGEST = 1 << 23


def mixed(x: np.ndarray) -> np.ndarray:
    """x, every bit of which then depends on all others; one to one."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _U61)
    return np.where(x >= _P, x - _P, x)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, of numbers below it."""
    ah, al, bh, bl = a >> _U31, a & _LOW31, b >> _U31, b & _LOW31
    mid = ah * bl + al * bh
    return _reduced(ah * bh * np.uint64(2) + (mid >> _U30) + ((mid & _LOW30) << _U31) + al * bl)


def digest128(parts: Iterable[bytes]) -> np.ndarray:
    """A row of two 64-bit numbers for each of the byte strings: their 128-bit BLAKE2b."""
    blake = hashlib.blake2b
    return np.frombuffer(b"".join([blake(p, digest_size=16).digest() for p in parts]), "<i8").reshape(-1, 2)


class PolyHash:
    def __init__(self, seed: int = 1) -> None:
        self.base = int(np.random.default_rng(seed).integers(1 << 32, PRIME - 1))
        self.high = self.low = self.inverse = np.zeros(0, np.uint64)

    def _grow(self, n: int) -> None:
        """Powers of the base, in two halves, and those of its inverse, by doubling."""
        n = max(n + 1, CHUNK_BYTES + (CHUNK_BYTES >> 2))
        power, inverse = (self._powers(b, n) for b in (self.base, pow(self.base, -1, PRIME)))
        self.high, self.low, self.inverse = power >> _U30, power & _LOW30, inverse

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.ones(n, np.uint64)
        have = 1
        while have < n:
            more = min(have, n - have)
            out[have : have + more] = product(out[:more], np.uint64(pow(base, have, PRIME)))
            have += more
        return out

    def prefix(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the bytes' products with the powers' halves; they may wrap, and their differences over LONGEST bytes don't."""
        n = len(data)
        if n >= len(self.inverse):
            self._grow(n)
        wide = data.astype(np.uint64) + np.uint64(1)
        sums = []
        for half in (self.high, self.low):
            out = np.zeros(n + 1, np.uint64)
            np.cumsum(wide * half[:n], out=out[1:])
            sums.append(out)
        return sums[0], sums[1]

    def windows(self, prefix: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
        far = np.flatnonzero(end - start > LONGEST)
        if len(far):
            out = self.windows(prefix, start, np.minimum(end, start + LONGEST))
            out[far] = [self._long(prefix, int(start[i]), int(end[i])) for i in far]
            return out
        return mixed(product(self._sums(prefix, start, end), self.inverse[start]))

    @staticmethod
    def _sums(prefix: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
        high = _reduced(prefix[0][end] - prefix[0][start])
        return _reduced((high >> _U31) + ((high & _LOW31) << _U30) + _reduced(prefix[1][end] - prefix[1][start]))

    def _long(self, prefix: tuple[np.ndarray, np.ndarray], start: int, end: int) -> np.uint64:
        at = np.arange(start, end, LONGEST)
        total = sum(self._sums(prefix, at, np.minimum(at + LONGEST, end)).tolist()) % PRIME
        return mixed(product(np.array([total], np.uint64), self.inverse[start : start + 1]))[0]


class AnchorHash:
    """A cheaper hash of byte windows, modulo 2 ^ 64, for choosing anchors alone: strings that share it only share a group."""

    def __init__(self, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 2**64, 256, dtype=np.uint64)
        self.base = int(rng.integers(1, 2**63, dtype=np.uint64)) * 8 + 5 & 2**64 - 1
        self.power = self.inverse = np.zeros(0, np.uint64)

    def all(self, data: np.ndarray, size: int) -> np.ndarray:
        """The hash of size bytes from each place on."""
        n = len(data)
        if n >= len(self.power):
            for name, b in (("power", self.base), ("inverse", pow(self.base, -1, 2**64))):
                steps = np.full(max(n + 1, CHUNK_BYTES + (CHUNK_BYTES >> 2)), b, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[data] * self.power[:n], out=prefix[1:])
        return mixed((prefix[size:] - prefix[: n + 1 - size]) * self.inverse[: n + 1 - size])


def pieces(texts: Sequence[list[bytes]], overlap: int) -> Iterator[tuple[list[int], list[int], list[list[bytes]]]]:
    """Texts, given as words, cut to PIECE_WORDS words and some that the next piece repeats, and packed to CHUNK_BYTES:
    the number of each piece's text, where in it the piece begins, and its words."""
    of, begins, held, size = [], [], [], 0
    for k, words in enumerate(texts):
        for at in range(0, len(words), PIECE_WORDS):
            if at and at + overlap >= len(words):
                break  # the piece before has all of it
            piece = words[at : at + PIECE_WORDS + overlap]
            of.append(k)
            begins.append(at)
            held.append(piece)
            size += sum(map(len, piece)) + len(piece)
            if size >= CHUNK_BYTES:
                yield of, begins, held
                of, begins, held, size = [], [], [], 0
    if of:
        yield of, begins, held


class Words:
    """Pieces laid end to end, one space between words: where words start and end, and each piece's first word."""

    def __init__(self, hasher: PolyHash, held: list[list[bytes]]) -> None:
        self.data = b" ".join(w for piece in held for w in piece) + b" "
        data = np.frombuffer(self.data, np.uint8)
        self.end = np.flatnonzero(data == 32)
        self.start = np.concatenate([[0], self.end[:-1] + 1])
        self.counts = np.array([len(p) for p in held])
        self.first = np.cumsum(self.counts) - self.counts
        self.last = np.repeat(self.first + self.counts, self.counts)  # after the last word of a word's piece
        self.hasher, self.prefix = hasher, hasher.prefix(data)

    def runs(self, first: np.ndarray, k: int) -> np.ndarray:
        """Hashes of the k words from each of the words first."""
        return self.hasher.windows(self.prefix, self.start[first], self.end[first + k - 1])

    def digests(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """digest128() of the words from each of first to its last, one space between them."""
        data = self.data
        return digest128([data[a:b] for a, b in zip(self.start[first].tolist(), self.end[last].tolist(), strict=True)])


def word_windows(hasher: PolyHash, texts: Sequence[list[bytes]], k: int, short: bool) -> list[np.ndarray]:
    """For each text the hashes of its windows of k words, in order; short: a text of fewer words is one window."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for of, _, held in pieces(texts, k - 1):
        w = Words(hasher, held)
        at = np.arange(len(w.start))
        size = np.full(len(at), k)
        ok = at + k <= w.last
        if short:
            few = w.first[w.counts < k]
            ok[few] = True
            size[few] = w.counts[w.counts < k]
        at = at[ok]
        got = hasher.windows(w.prefix, w.start[at], w.end[at + size[ok] - 1])
        n = np.maximum(w.counts - k + 1, 1 if short else 0)
        stop = np.cumsum(n)
        for i, a, b in zip(of, stop - n, stop, strict=True):
            out[i].append(got[a:b])
    none = np.zeros(0, np.uint64)
    return [np.concatenate(x) if len(x) > 1 else x[0] if x else none for x in out]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for each i, by doubling."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


#: Bits of a place in a pack.
PLACE_BITS = 22


def anchored_runs(grams: np.ndarray, width: int, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that share an anchor: first window, number of windows, and the anchor's place.

    A window begins at each place where valid is true, and its anchor is the least of the width hashes from there on, of equal
    ones the first; equal windows have equal anchors, at equal distances.
    """
    low = np.uint64(PLACE_BITS)
    packed = (grams >> low << low) | np.arange(len(grams), dtype=np.uint64)
    place = (sliding_min(packed, width) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    valid = valid[: len(place)]
    first = np.flatnonzero((np.diff(place, prepend=-1) != 0) | np.diff(valid, prepend=~valid[:1]))
    n = np.diff(first, append=len(place))
    ok = valid[first]
    return first[ok], n[ok], place[first[ok]]
