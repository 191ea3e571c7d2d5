from __future__ import annotations

from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pin(df, **named):
    """Add each named expression as a column that is evaluated once per row.

    Catalyst substitutes a projected expression into every filter and projection
    that reads it; for a regex split or a time-zone conversion read by many fields
    that means many evaluations per row and oversized generated code. A one-element
    ``inline`` is a Generate node, which later filters are not pushed through, so
    the expression runs once and the rest reads its result."""
    from pyspark.sql import functions as F

    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in named.items()]))))
