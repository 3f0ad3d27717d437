"""Physical layout of written outputs.

Use only right before a write. A ``repartition`` keyed on a column other than
the next aggregate's key adds a shuffle and caps parallelism at ``n``; before a
``groupBy`` it is pure cost, so the KPI operators never call it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def layout(
    df: DataFrame,
    n: int | None = None,
    by: str | list[str] | None = None,
    sort_by: str | list[str] | None = None,
    even: bool = False,
) -> DataFrame:
    """Hash-repartition by ``by`` (into ``n`` files, or AQE-sized when
    ``n`` is None); R2: sort rows within each partition by ``sort_by``.

    ``even`` cuts the rows by ranges of ``by`` and a hash of the row instead, at
    borders that Spark samples: a key that holds a third of all rows (or the
    null key) spreads over as many files as it needs, each file holds
    neighbouring keys, and all are about equally large.
    """
    keys = [by] if isinstance(by, str) else list(by or [])
    if even and keys:
        ranges = [*keys, F.xxhash64(*df.columns)]
        df = df.repartitionByRange(n, *ranges) if n else df.repartitionByRange(*ranges)
    elif keys:
        df = df.repartition(n, *keys) if n else df.repartition(*keys)
    elif n:
        df = df.repartition(n)
    if sort_by:
        sort_keys = [sort_by] if isinstance(sort_by, str) else list(sort_by)
        df = df.sortWithinPartitions(*sort_keys)
    return df
