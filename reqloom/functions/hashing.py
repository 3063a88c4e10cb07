"""Stand-in values derived from the md5 of a text.

The md5 is a 128-bit integer h. Every stand-in needs h modulo a small number, or (h div k) modulo m, and
(h div k) % m == (h % (k * m)) div k. All those moduli divide 51,000, so one residue serves them all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_MODULUS = 51_000
_CHUNK = pow(2, 32, HASH_MODULUS)


def residue_of(digest: Column) -> Column:
    """An md5 in hex as an integer, modulo HASH_MODULUS: four 32-bit chunks, most significant first."""
    residue = F.lit(0).cast("bigint")
    for start in (1, 9, 17, 25):
        chunk = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
        residue = (residue * F.lit(_CHUNK) + chunk) % F.lit(HASH_MODULUS)
    return residue


def with_residue(df: DataFrame, text: Column, name: str, where: Column | None = None) -> DataFrame:
    """Adds the residue of md5(text) as a column, so that several stand-ins share one hash.

    `where` limits the hash to the rows that need one; the others get null.
    """
    digest = F.md5(text.cast("string").cast("binary"))
    marked = df.withColumn(f"{name}_md5", digest if where is None else F.when(where, digest))
    return marked.withColumn(name, residue_of(F.col(f"{name}_md5"))).drop(f"{name}_md5")


def stand_in_status(residue: Column, codes: Sequence[int]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in codes]), (residue % 10 + 1).cast("int"))


def stand_in_latency(residue: Column) -> Column:
    """80..1579 ms."""
    return residue % 1500 + 80


def stand_in_ip_flat(residue: Column) -> Column:
    octets = [residue % 255, _div(residue % 2550, 10), _div(residue % 25500, 100)]
    return _private_ip(octets)


def stand_in_ip_entry(residue: Column) -> Column:
    return _private_ip([residue % 255, residue % 200, residue % 100])


def _div(dividend: Column, divisor: int) -> Column:
    """Whole division of non-negative numbers that stays a bigint."""
    return ((dividend - dividend % divisor) / divisor).cast("bigint")


def _private_ip(octets: Sequence[Column]) -> Column:
    return F.concat_ws(".", F.lit("10"), *[o.cast("string") for o in octets])
