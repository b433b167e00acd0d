"""Place of a value among sorted cut points, as one SQL expression."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def cuts_at_or_below(value: Column, cuts: Sequence[Column]) -> Column:
    """How many of the ascending ``cuts`` (literals) are at or below ``value``.

    Whole groups of cuts are skipped first, so a row costs two times the root of their number.
    """
    if not cuts:
        return F.lit(0)
    width = math.isqrt(len(cuts)) + 1
    groups = [list(cuts[i : i + width]) for i in range(0, len(cuts), width)]
    last = F.array(*(g[-1] for g in groups))
    full = F.size(F.filter(last, lambda c: c <= value))
    inside = F.get(F.array(*(F.array(*g) for g in groups)), full)
    rest = F.size(F.filter(inside, lambda c: c <= value))
    return F.when(full == len(groups), F.lit(len(cuts))).otherwise(full * width + rest).cast("int")
