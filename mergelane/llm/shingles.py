"""Sets of hashed word shingles, formed for whole batches of texts at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from mergelane.llm.arrow import LOWER, text_bytes

# Bytes of texts that are worked on at once; the arrays for them take some 40 times as much.
BATCH_BYTES = 1 << 20

_LOWER = np.frombuffer(LOWER, dtype=np.uint8)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# An odd factor, and its inverse modulo 2^64, so that a word's polynomial can be shifted to its start.
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _powers_of(factor: int, n: int) -> np.ndarray:
    known = _powers.get(factor)
    if known is None or len(known) < n:
        size = max(n, BATCH_BYTES + BATCH_BYTES // 4)
        known = np.full(size, factor, dtype=np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= 2 * BATCH_BYTES:  # those for one very long text are not kept
            _powers[factor] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finalizer of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass
class Sets:
    """`tokens` of text i, ascending and distinct, from ``ends[i]`` up to ``ends[i + 1]``."""

    tokens: np.ndarray  # int64
    ends: np.ndarray
    words: np.ndarray  # number of words of each text

    def __len__(self) -> int:
        return len(self.ends) - 1

    def __getitem__(self, i: int) -> np.ndarray:
        return self.tokens[self.ends[i] : self.ends[i + 1]]


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (between ASCII white space, A-Z lower-cased) and the text each is in."""
    parts = text_bytes(column)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    data = np.frombuffer(b" ".join([*parts, b""]), dtype=np.uint8)  # a blank behind every text
    blank = np.ones(len(data) + 1, dtype=bool)
    blank[1:] = _BLANK[data]
    change = np.flatnonzero(blank[1:] != blank[:-1])
    starts, stops = change[0::2], change[1::2]
    values = (_LOWER[data].astype(np.uint64) + np.uint64(1)) * _powers_of(_FACTOR, len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values, out=sums[1:])
    hashes = (sums[stops] - sums[starts]) * _powers_of(_INVERSE, len(data))[starts]
    hashes = mix(hashes ^ (stops - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    return hashes, np.searchsorted(begins, starts, side="right") - 1


def shingle_sets(column: pa.Array, size: int) -> Sets:
    """The set of hashed `size`-word shingles of each text; fewer words are one shingle, none are none."""
    n = len(column)
    hashes, text = words_of(column)
    counts = np.bincount(text, minlength=n)
    last = np.concatenate([[0], np.cumsum(counts)])
    joined = np.zeros(max(0, len(hashes) - size + 1), dtype=np.uint64)
    for k in range(size):
        joined = mix(joined * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(joined)])
    inside = text[: len(joined)] == text[size - 1 : size - 1 + len(joined)]
    tokens, owner = [joined[inside]], [text[: len(joined)][inside]]
    for i in np.flatnonzero((counts > 0) & (counts < size)).tolist():
        few = np.uint64(counts[i])
        one = np.array([few], dtype=np.uint64)
        for h in hashes[last[i] : last[i + 1]]:
            one = mix(one * np.uint64(0x9E3779B97F4A7C15) + h)
        tokens.append(one)
        owner.append(np.array([i]))
    all_tokens, all_owners = np.concatenate(tokens).view(np.int64), np.concatenate(owner)
    order = np.lexsort((all_tokens, all_owners))
    all_tokens, all_owners = all_tokens[order], all_owners[order]
    new = np.ones(len(all_tokens), dtype=bool)
    new[1:] = (all_tokens[1:] != all_tokens[:-1]) | (all_owners[1:] != all_owners[:-1])
    all_tokens, all_owners = all_tokens[new], all_owners[new]
    ends = np.concatenate([[0], np.cumsum(np.bincount(all_owners, minlength=n))])
    return Sets(all_tokens, ends, counts)


def set_digests(sets: Sets) -> np.ndarray:
    """A 64-bit digest of each set, the same for equal sets; 0 for an empty one, and for no other."""
    sums = np.zeros(len(sets.tokens) + 1, dtype=np.uint64)
    np.cumsum(mix(sets.tokens.view(np.uint64) ^ np.uint64(0xA0761D6478BD642F)), out=sums[1:])
    sizes = np.diff(sets.ends)
    out = mix(sums[sets.ends[1:]] - sums[sets.ends[:-1]] + sizes.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))
    out[out == 0] = 1
    return np.where(sizes > 0, out, np.uint64(0)).view(np.int64)
