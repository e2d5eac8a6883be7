"""Shingle fingerprints and the hash family behind the signatures.

Shingle s has the fingerprint (hi, lo): hex digits 1-7 and 8-14 of md5(s). Hash i maps
it to (a_i*hi + c_i*lo + b_i) mod (2^31 - 1); the coefficients are md5 prefixes of 'a',
'b', 'c' followed by i. All products stay below 2^57, and any SQL engine with md5 can
recompute the family.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

MODULUS = 2**31 - 1
# Stands in for the minimum over no shingles; larger than every hash value.
NO_SHINGLE = MODULUS


def fingerprint(shingle: Column) -> Column:
    """The 16 md5 bytes of the shingle."""
    return F.unhex(F.md5(shingle))


def coefficients(num_hashes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    def column(letter: str, low: int) -> np.ndarray:
        digests = (hashlib.md5(f"{letter}{i}".encode()).hexdigest() for i in range(num_hashes))
        return np.array([low + int(d[:7], 16) for d in digests], dtype=np.uint64)

    return column("a", 1), column("b", 0), column("c", 1)


def split_fingerprints(md5_bytes: np.ndarray) -> np.ndarray:
    """Leading 56 bits of each 16-byte row as one integer."""
    head = np.ascontiguousarray(md5_bytes.reshape(-1, 16)[:, :8])
    return head.view(">u8").ravel().astype(np.uint64) >> np.uint64(8)


def run_minima(
    fingerprints: np.ndarray, run_starts: np.ndarray, family: tuple[np.ndarray, ...]
) -> np.ndarray:
    """Minimum of every hash over each run of fingerprints: (runs, hashes) int32."""
    a, b, c = family
    hi, lo = fingerprints >> np.uint64(28), fingerprints & np.uint64(2**28 - 1)
    p, shift = np.uint64(MODULUS), np.uint64(31)
    h, t = np.empty_like(hi), np.empty_like(hi)
    minima = np.empty((len(a), len(run_starts)), dtype=np.int32)
    for i in range(len(a)):
        np.multiply(hi, a[i], out=h)
        np.multiply(lo, c[i], out=t)
        h += t
        h += b[i]
        # Fold the high bits down, then subtract the modulus where it still fits.
        np.right_shift(h, shift, out=t)
        h &= p
        h += t
        np.subtract(h, p, out=t)
        np.minimum(h, t, out=h)
        minima[i] = np.minimum.reduceat(h, run_starts)
    return minima.T
