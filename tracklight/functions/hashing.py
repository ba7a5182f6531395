"""Seeded pseudo-random numbers from md5, equal in every engine and for every partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 2**48


def digest(*parts) -> Column:
    """md5 text of the parts joined by ``-``."""
    return F.md5(F.concat_ws("-", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts]))


def hash48(*parts) -> Column:
    """Integer in [0, 2^48) from the first twelve hex digits."""
    return F.conv(F.substring(digest(*parts), 1, 12), 16, 10).cast("bigint")


def uniform(*parts) -> Column:
    """Number in [0, 1)."""
    return hash48(*parts) / F.lit(float(HASH_RANGE))
