"""Column-expression builders (JVM built-ins only, no UDFs)."""

from trackframe.functions.casts import lenient_double, lenient_int, parse_as
from trackframe.functions.expressions import (
    is_finite,
    net_score,
    nps_segment,
    recode,
    top_box,
    weighted_share,
    weighted_sum_if,
)

__all__ = [
    "is_finite",
    "lenient_double",
    "lenient_int",
    "net_score",
    "nps_segment",
    "parse_as",
    "recode",
    "top_box",
    "weighted_share",
    "weighted_sum_if",
]
