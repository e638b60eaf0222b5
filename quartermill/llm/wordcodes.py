"""Words of many texts as numbers: where they lie in an Arrow buffer, and hashes of them.

Nothing here makes a Python object per word. A word's hash reads its bytes eight at
a time; a sequence's hash comes from prefix sums of the word hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np

#: Odd multipliers of the hashes.
MULT = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
#: Words of more than this many chunks of eight bytes are hashed one by one.
CHUNKS = 32
MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)


def byte_class(members: Iterable[int]) -> np.ndarray:
    """A table of 256 flags."""
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte behind the last of every word of texts that lie back to back.

    ``gap`` flags the bytes that are in no word. No word goes over the end of a text.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~gap[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, word[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, word[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    return np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of each word; the two lanes are independent of each other."""
    lengths = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    chunk = np.ndarray((len(data) + 1,), np.dtype("<u8"), buffer=padded.data, strides=(1,))
    k = MULT[lane]
    out = mix((chunk[starts] & MASKS[np.minimum(lengths, 8)]) * k + lengths.astype(np.uint64))
    left, at = np.flatnonzero(lengths > 8), 8
    while len(left) and at < 8 * CHUNKS:
        size = lengths[left] - at
        out[left] = mix((out[left] ^ (chunk[starts[left] + at] & MASKS[np.minimum(size, 8)])) * k)
        left, at = left[size > 8], at + 8
    for i in left.tolist():
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, salt=bytes([lane])).digest()
        out[i] = np.uint64(int.from_bytes(digest, "little"))
    return out


def powers(n: int, base: np.uint64) -> np.ndarray:
    """``base ** i`` for i below ``n``, in 64 bits."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Sequences:
    """Hashes of runs of words, from prefix sums over their codes."""

    def __init__(self, codes: np.ndarray, lane: int = 0):
        base = MULT[lane]
        self.inverse = powers(len(codes), np.uint64(pow(int(base), -1, 1 << 64)))
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * powers(len(codes), base), out=self.sums[1:])

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        """Hash of the ``length`` words from each start."""
        return mix((self.sums[starts + length] - self.sums[starts]) * self.inverse[starts])
