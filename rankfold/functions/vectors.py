"""Column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankfold import config


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    """Dot product of two equal-length double arrays (null if either is null)."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y),
                       F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda acc, v: acc + v * v))


def clip_rating(x, lo: float = config.CLIP_LO, hi: float = config.CLIP_HI) -> Column:
    """Clip to the rating scale.  ``x`` must be non-null (greatest/least skip nulls)."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), _c(x)))


def split_bucket(user_col="user_id", item_col="item_id", method: str = "xxhash",
                 buckets: int = 1_000_000, seed: int = 42) -> Column:
    """Deterministic bucket in ``[0, buckets)`` of a (user, item) pair.

    ``linear`` is ``(31*user + 17*item + 7) mod buckets``: portable to any SQL
    engine, so an oracle can reproduce the split exactly.  ``xxhash`` mixes
    the ids with a seeded 64-bit hash.  Both are functions of the pair only,
    hence stable under any repartitioning (unlike a seeded random split).
    """
    u, i = _c(user_col), _c(item_col)
    if method == "linear":
        n = F.lit(buckets)  # of each id first: no id is too large
        return F.pmod(F.pmod(u, n) * 31 + F.pmod(i, n) * 17 + 7, n)
    if method == "xxhash":
        return F.pmod(F.xxhash64(u, i, F.lit(seed)), F.lit(buckets))
    raise ValueError(f"unknown split method {method!r}")
