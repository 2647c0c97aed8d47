"""Identifier and key expressions (P9, the order-line id of the adapters, ordered pair keys)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsemart.functions.dates import idiv


def alert_doc_id(mid, ts_ms) -> Column:
    """Device id followed by the epoch minute of ``ts_ms`` (ms / 1000 / 60)."""
    mid_col = F.col(mid) if isinstance(mid, str) else mid
    ts_col = F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms
    return F.concat(mid_col, idiv(idiv(ts_col, 1000), 60).cast("string"))


def joined_key(*cols: str, sep: str = "-") -> Column:
    """A string key from several columns, ``sep``-separated."""
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in cols])


# A (long, long) pair as one decimal(38,0) whose order is the pair's
# lexicographic order: major * 2^64 + (minor + 2^63).  Spark keeps decimals
# in place in its aggregation buffers (structs it cannot), so ``min`` /
# ``max`` of this key run as hash aggregates with code generation, where
# ``min_by(struct)`` falls back to sorting every task's input.  Exact for
# |major| < 5 * 10^18 (epoch ms: any date of the next hundred million years).
_SHIFT = Decimal(2**64)
_BIAS = Decimal(2**63)
_KEY_TYPE = "decimal(38,0)"


def pair_key(major, minor) -> Column:
    """Order-preserving decimal key of two longs (``major`` first)."""
    hi = _as_col(major).cast(_KEY_TYPE) * F.lit(_SHIFT)
    return (hi + (_as_col(minor).cast(_KEY_TYPE) + F.lit(_BIAS))).cast(_KEY_TYPE)


def pair_major(key) -> Column:
    # Divide an exact multiple of 2^64: decimal division rounds its quotient
    # to a fixed scale, which would push a fraction near 1 up to the next
    # integer.
    k = _as_col(key)
    return ((k - F.pmod(k, F.lit(_SHIFT))) / F.lit(_SHIFT)).cast("long")


def pair_minor(key) -> Column:
    return (F.pmod(_as_col(key), F.lit(_SHIFT)) - F.lit(_BIAS)).cast("long")


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
