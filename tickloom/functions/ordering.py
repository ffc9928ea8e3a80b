"""Sort keys for first/last aggregates.

``min_by``/``max_by`` over a struct forces a SortAggregate, which sorts every input
partition before the shuffle. Over a fixed-width key the plan is a HashAggregate, so
the sort columns are packed into one number here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 20 bits hold any six-digit HHMMSS value, the other 43 a row number up to 8.7e12.
SEQ_BITS = 43
MAX_LOG_TIME = (1 << (63 - SEQ_BITS)) - 1
MAX_SEQ = (1 << SEQ_BITS) - 1


def tick_order(log_time="Log_Time", seq="seq") -> Column:
    """``(Log_Time, seq)`` packed into one BIGINT, order preserving.

    Values that do not fit raise instead of wrapping round into a wrong order. The file
    readers quarantine such times before they get here.
    """
    time, row = F.col(log_time).cast("bigint"), F.col(seq).cast("bigint")
    packed = F.shiftleft(time, SEQ_BITS) + row
    fits = time.between(0, MAX_LOG_TIME) & row.between(0, MAX_SEQ)
    return F.when(fits | time.isNull() | row.isNull(), packed).otherwise(
        F.raise_error(F.lit("tick order key out of range")).cast("bigint")
    )


def ledger_order(changed_at="changed_at", seq="seq") -> Column:
    """``(changed_at, seq)`` packed into one decimal; exact for every instant and BIGINT.

    ``changed_at`` is a wall-clock TIMESTAMP_NTZ, so the key does not depend on the
    session time zone. Two instants are 2e19 apart, the width of the BIGINT range.
    """
    since_epoch = F.col(changed_at) - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = since_epoch.cast("interval second").cast("decimal(18,6)")
    micros = (seconds * F.lit(1000000)).cast("decimal(18,0)")
    step = F.lit("20000000000000000000").cast("decimal(20,0)")
    return (micros * step).cast("decimal(38,0)") + F.col(seq).cast("decimal(19,0)")
