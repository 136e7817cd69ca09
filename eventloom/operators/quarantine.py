"""Per-record quarantine.

A record that cannot be loaded is not fatal: it is set aside with a ``reason``
(``xml``, ``root``, ``timestamp`` or ``shape``) and the load goes on.  Both
outputs come from one parse; when both are consumed, persist or write them in one
job (as :func:`eventloom.sinks.write_bulk_files` does) rather than parsing twice.
A bad item inside a ``Data`` list (E6) is skipped by the map builder and never
rejects its record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accepted_events(df: DataFrame) -> DataFrame:
    """Records that load."""
    return df.where(F.col("reason").isNull())


def rejected_events(df: DataFrame, keep: tuple[str, ...] = ("xml",)) -> DataFrame:
    """Records set aside, with their ``reason`` (and the input columns in ``keep``)."""
    return df.where(F.col("reason").isNotNull()).select(*keep, "reason")


def reject_summary(df: DataFrame) -> DataFrame:
    """Number of rejected records per reason (map-side partial counts, one tiny shuffle)."""
    return df.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
