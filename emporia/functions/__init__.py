"""Column-level building blocks: built-in Spark expressions only, no UDFs."""

from emporia.functions.money import (  # noqa: F401
    cents,
    cents_to_double,
    money,
    net_amount,
    net_cents,
    mean,
    ratio_half_up,
)
from emporia.functions.rules import (  # noqa: F401
    COMPLETED_STATUSES,
    CANCELLED_STATUS,
    SENTIMENTS,
    is_completed,
    is_not_cancelled,
    segment_of,
    sentiment_from_rating,
)
