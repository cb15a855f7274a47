"""Deterministic first/last values.

``FIRST_VALUE``/``LAST_VALUE`` without an order depend on arrival order.
Here open/close are defined by the total order (ts, seq), where ``seq`` is
the source offset, so replays and shuffles give the same answer.

(ts, seq) is packed into one DECIMAL(38,0): ``ts * 2e19 + seq``.  The seq
span of a signed long (about 1.85e19) is below the multiplier, so the
packing is order-preserving for every long seq and every |ts| up to 4e18 (as
epoch milliseconds or microseconds: beyond the year 100,000), and a decimal
aggregation buffer is mutable in place, which keeps ``min_by``/``max_by`` in
a partial + final HashAggregate (a struct key would force SortAggregate).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_KEY = "decimal(38,0)"
_SHIFT = "20000000000000000000"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def order_key(ts="ts", seq="seq") -> Column:
    """Single order-preserving key for the pair (ts, seq) of longs."""
    return _c(ts).cast(_KEY) * F.lit(_SHIFT).cast(_KEY) + _c(seq).cast(_KEY)


def first_value(value, ts="ts", seq="seq") -> Column:
    return F.min_by(_c(value), order_key(ts, seq))


def last_value(value, ts="ts", seq="seq") -> Column:
    return F.max_by(_c(value), order_key(ts, seq))
