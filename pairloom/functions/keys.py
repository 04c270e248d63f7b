"""Reproducible random keys.

They depend on the row id and the seed alone: the same on every engine, under
any partitioning and after any task is run again.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SEED = 123
_DIGITS = 13  # 52 bits, exact in a double


def digest(key: Column, *salt) -> Column:
    """md5 of ``key:salt[:salt...]``, in hex."""
    return F.md5(F.concat_ws(":", key.cast("string"), *[F.lit(str(s)) for s in salt]))


def uniform(key: Column, seed: int = SEED) -> Column:
    """A number strictly between 0 and 1."""
    whole = F.conv(F.substring(digest(key, seed), 1, _DIGITS), 16, 10).cast("bigint")
    return (whole + 1) / F.lit(float(16**_DIGITS + 1))


def arrival(unit: Column, weight: Column) -> Column:
    """Exponential arrival time ``-ln(u) / weight`` of a uniform ``unit``.

    Rows in order of arrival are a weighted draw without replacement
    (Efraimidis and Spirakis 2006: the same order as ``u^(1/w)`` descending).
    A row of null or no weight never arrives.
    """
    drawn = (weight > 0) & ~F.isnan(weight)
    return F.when(drawn, -F.log(unit) / weight).otherwise(F.lit(float("inf")))


_TINY = 1e-300
_NEVER = 2**30


def arrival_bucket(time: Column, unit: Column, per_unit: int = 1024) -> Column:
    """A bucket that never falls as ``(time, unit)`` grows, even for any weights.

    Buckets are equal in ``ln(time)``. An exponential of any rate puts at most
    ``1 / (e * per_unit)`` of its mass in one, so neither does a mixture: no
    bucket gets more than 0.04 % of the rows whatever the weights. The range of a
    double bounds their number (under 1.5 million; about 27,000 for weights of
    one magnitude). Rows that never arrive are spread by ``unit``.
    """
    return F.when(
        time == float("inf"), F.lit(_NEVER) + F.floor(unit * 4096).cast("int")
    ).otherwise(F.floor(F.log(F.greatest(time, F.lit(_TINY))) * per_unit).cast("int"))


def hex_bucket(digest_column: Column, digits: int = 4) -> Column:
    """The leading hex digits of a digest: 16^digits even buckets, in order."""
    return F.conv(F.substring(digest_column, 1, digits), 16, 10).cast("int")
