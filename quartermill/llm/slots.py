"""A Bloom filter of hashes, small enough for a broadcast however many hashes there are."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the largest filter (16 MB). The more hashes there are, the more others pass, but never less.
MOST_BITS = 27
#: Bits per hash, below that size.
ROOM = 6


def slot(hashes: np.ndarray, which: int, size: int) -> np.ndarray:
    """One of the two places of each hash in a bitmap of ``2 ** size`` bits."""
    return (hashes.view(np.uint64) << np.uint64(which * (64 - MOST_BITS))) >> np.uint64(64 - size)


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """Two flags for every hash in a long column: its first bits, and later ones.

    Spark ORs them into cells of 64 bits; the driver gets those that aren't empty,
    2 million at most.
    """
    places = [F.shiftrightunsigned(F.shiftleft(column, which * (64 - MOST_BITS)), 64 - MOST_BITS) for which in (0, 1)]
    at = hashes.select(F.explode(F.array(*places)).alias("at"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))
    cells = at.groupBy(F.shiftright("at", 6).alias("cell")).agg(F.bit_or(one).alias("bits")).toArrow()
    at, bits = (cells.column(k).to_numpy() for k in ("cell", "bits"))
    n = max(1, int(np.bitwise_count(bits).sum()))
    full = np.zeros(1 << (MOST_BITS - 6), np.uint64)
    full[at] = bits.view(np.uint64)
    flags = np.unpackbits(full.view(np.uint8), bitorder="little")
    size = min(MOST_BITS, max(10, n.bit_length() + ROOM))
    flags = flags.reshape(1 << size, -1).any(axis=1)
    return np.packbits(flags, bitorder="little")


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes (64-bit numbers of either sign) the bitmap lets pass: all that it was made of."""
    size, out = len(bits).bit_length() + 2, np.ones(len(hashes), bool)
    for which in (0, 1):
        at = slot(hashes, which, size)
        out &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out
