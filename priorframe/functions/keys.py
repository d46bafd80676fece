"""Pseudonymous keys and reproducible hash sampling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pseudonym(salt: str, period: Column, raw: Column, length: int = 16) -> Column:
    """Salted SHA-256 prefix; the period in the salt rotates the key."""
    text = F.concat_ws("|", F.lit(salt), period.cast("string"), raw.cast("string"))
    return F.substring(F.sha2(text, 256), 1, length)


def md5_modulo(c: Column, modulus: int) -> Column:
    """The 128-bit MD5 of a text modulo M, folded eight hex digits at a time."""
    if not 0 < modulus < 2**30:
        raise ValueError("modulus must fit the 62-bit fold")
    digest = F.md5(c.cast("string"))
    rest = F.lit(0).cast("bigint")
    for i in range(4):
        part = F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint")
        rest = F.pmod(rest * F.lit(2**32 % modulus) + part, F.lit(modulus))
    return rest


def hash_sampled(c: Column, modulus: int) -> Column:
    return md5_modulo(c, modulus) == 0


# Odd multipliers below 2^31, so that products of 32-bit words stay in 63 bits.
MIX = (1640531527, 668265263, 374761393)


def mixed(a: Column, b: Column) -> Column:
    """A 32-bit mix of two non-negative integers by shifts and products.

    Plain integer arithmetic, so that any SQL engine can repeat it.
    """
    word = F.lit(2**32)
    h = F.pmod(F.pmod(a, F.lit(2**31)) * F.lit(MIX[0]) + b * F.lit(MIX[2]), word)
    h = F.pmod(h.bitwiseXOR(F.shiftright(h, 15)) * F.lit(MIX[1]), word)
    return h.bitwiseXOR(F.shiftright(h, 13))
