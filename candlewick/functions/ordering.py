from decimal import Decimal

from pyspark.sql import Column, functions as F

# One step of trade time outweighs any 64-bit trade id; the largest key still has 38 digits.
_TIME_STEP = Decimal(10**19)
_POSITIVE_BITS = 0x7FFFFFFFFFFFFFFF


def trade_order(time_ms: str = "trade_time_ms", trade_id: str = "trade_id") -> Column:
    """Total order of trades: time first, then id, as one DECIMAL(38,0).

    A decimal fits the fixed-width aggregation buffer, so `min_by`/`max_by` stay in HashAggregate;
    ordering by a struct would sort every input row. An id that is no whole number is ordered by its hash.
    """
    number = F.col(trade_id).try_cast("bigint")
    hashed = F.xxhash64(trade_id).bitwiseAND(F.lit(_POSITIVE_BITS))
    tiebreak = F.when(number >= 0, number).otherwise(hashed)
    millis = F.col(time_ms).cast("decimal(19,0)")
    return (millis * F.lit(_TIME_STEP) + tiebreak.cast("decimal(19,0)")).cast("decimal(38,0)")
