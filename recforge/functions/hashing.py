"""Deterministic draws shared with the SQL oracle.

Operators that draw at random but are checked exactly (samples, splits,
negatives, walks, crosses) take their numbers from MD5, which every SQL engine
computes alike: the first 15 hex digits of the digest of the seed and the keys
as text.  Seed, slot and step are part of the text, so the draws of two of
them have nothing to do with each other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAWS = 1 << 60  # draws lie in [0, DRAWS)


def draw(seed: int, *keys: Column) -> Column:
    """A bigint in [0, 2^60) from a seed and key columns; a null key is a value of its own."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(k.cast("string"), F.lit("~")) for k in keys))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def share(fraction: float) -> int:
    """Draws below this are ``fraction`` of all of them."""
    return int(round(fraction * DRAWS))


def uniform_excluding(h: Column, own: Column, n: int) -> Column:
    """An id in ``0 .. n-1`` other than ``own``, chosen by draw ``h``.

    ``r = h mod (n-1)``; ids at or above ``own`` shift up by one, so ``own``
    is never drawn and every other id is equally likely.  An ``own`` outside
    the domain excludes nothing: ``h mod n``.
    """
    r = F.pmod(h, F.lit(n - 1).cast("long"))
    inside = own.isNotNull() & (own >= 0) & (own < n)
    return F.when(inside, r + F.when(r >= own, 1).otherwise(0)).otherwise(F.pmod(h, F.lit(n).cast("long")))
