"""Digest columns and arithmetic on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest_mod(digest: Column, n: int) -> Column:
    """A 32-sign hex digest, read as one big number, modulo ``n`` (n < 2^46).

    The number has 128 bits, so the remainder is built part by part; the parts are
    short enough that no product leaves 63 bits.
    """
    if not 0 < n < 1 << 46:
        raise ValueError("the modulus must be between 1 and 2^46 - 1")
    signs = 8 if n < 1 << 31 else 4
    rest = F.lit(0).cast("long")
    for start in range(0, 32, signs):
        word = F.conv(F.substring(digest, start + 1, signs), 16, 10).cast("long")
        rest = (rest * F.lit(1 << 4 * signs) + word) % F.lit(n)
    return rest


def md5_mod(text: Column, n: int) -> Column:
    return digest_mod(F.md5(text), n)
