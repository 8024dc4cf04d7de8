"""Column expressions: all built-in, so plans stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# A prime below 2**31: products with the scrambling factor stay far below 2**63,
# and hashes are exact as doubles.
HASH_MODULUS = 2_147_483_647
HASH_FACTOR = 48_271
HASH_PRIMES = (7_919, 104_729, 1_299_709, 15_485_863, 32_452_843)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def is_missing(value: Column) -> Column:
    return value.isNull() | F.isnan(value)


def as_label(value: Column) -> Column:
    """Truncating cast to int; values with no int become NULL instead of failing."""
    return value.try_cast("int")


def sigmoid(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def key_hash(columns: Sequence[str], seed: int = 0) -> Column:
    """Hash of integer keys of any sign and size in [0, HASH_MODULUS); NULL counts as a key of its own.

    Plain integer arithmetic: any SQL engine gives the same value, and the
    value does not depend on how the rows are partitioned. Every step is
    reduced, so no 64-bit key overflows.
    """
    if not columns:
        raise ValueError("at least one key column")
    modulus = F.lit(HASH_MODULUS)
    total = F.pmod(F.lit(seed).cast("long"), modulus)
    for i, name in enumerate(columns):
        prime = HASH_PRIMES[i] if i < len(HASH_PRIMES) else pow(HASH_FACTOR, i, HASH_MODULUS)
        key = F.coalesce(F.pmod(F.col(name).cast("long"), modulus), F.lit(HASH_MODULUS - 1))
        total = (total + key * F.lit(prime)) % modulus
    return total * F.lit(HASH_FACTOR) % modulus


def row_hash(columns: Sequence[str], seed: int = 0) -> Column:
    """Hash of whole rows in [0, HASH_MODULUS), for tables without integer keys."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in columns]), F.lit(HASH_MODULUS))
