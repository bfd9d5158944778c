"""Progress figures as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signpost.functions.text import _c


def progress_pct(source_lines, processed) -> Column:
    """Per cent done: 100 only on an exact match, otherwise at most 99.9."""
    source, done = _c(source_lines), F.coalesce(_c(processed), F.lit(0))
    # The guard inside keeps the division defined whatever branch is evaluated first.
    share = done / F.when(source > 0, source) * 100
    return (
        F.when(F.coalesce(source, F.lit(0)) <= 0, F.lit(0.0))
        .when(done == source, F.lit(100.0))
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(99.9), share)))
    )


def progress_status(pct) -> Column:
    pct = _c(pct)
    return F.when(pct >= 100, "completed").when(pct > 0, "processing").otherwise("pending")
