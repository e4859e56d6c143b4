"""Space-filling-curve order of a few small integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def interleaved(*columns: Column, bits: int = 16) -> Column:
    """The lowest ``bits`` bits of the columns interleaved (Morton order): rows that
    are near in this order are near in every column.  NULL counts as 0."""
    if bits * len(columns) > 63:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit 63 bits")
    out = F.lit(0).cast("long")
    for k, c in enumerate(columns):
        x = F.coalesce(c.cast("long"), F.lit(0).cast("long"))
        for b in range(bits):
            bit = F.shiftright(x, b).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, b * len(columns) + k))
    return out
