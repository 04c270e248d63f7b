"""Counting rows as they pass."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery

UNIT = 100_000


def with_progress(df: DataFrame, name: str = "progress", unit: int = UNIT) -> tuple[DataFrame, Observation]:
    """``df`` unchanged, and an observation that after the first action holds
    ``processed`` rows and how many whole ``units`` they make."""
    seen = Observation(name)
    n = F.count(F.lit(1))
    return df.observe(seen, n.alias("processed"), F.floor(n / unit).alias("units")), seen


def counted_stream(stream: DataFrame, name: str = "progress") -> DataFrame:
    """A streaming table unchanged, whose micro-batches tell how many rows they had."""
    return stream.observe(name, F.count(F.lit(1)).alias("processed"))


def running_counts(query: StreamingQuery, name: str = "progress", unit: int = UNIT, wait: float = 0.2) -> Iterator[tuple[int, int]]:
    """(rows so far, whole units in them) while ``query``, which writes a ``counted_stream``, runs:
    one pair whenever finished micro-batches have filled another unit, and the total at its end.

    A batch that is run again counts once, by its number. Only the progress reports that
    the query keeps are read, so nothing is added to the job; should more batches end
    between two looks than it keeps, that is an error and not a wrong count. A query that
    failed raises its error here.
    """
    processed = told = 0
    due = None
    while True:
        ended = query.awaitTermination(wait)
        for report in query.recentProgress:
            batch, seen = report["batchId"], report["observedMetrics"].get(name)
            if seen is None or (due is not None and batch < due):
                continue
            if due is not None and batch > due:
                raise RuntimeError(f"reports of batches {due} to {batch - 1} are gone; look more often or keep more of them")
            processed, due = processed + seen["processed"], batch + 1
        if ended:
            yield processed, processed // unit
            return
        if processed // unit > told:
            told = processed // unit
            yield processed, told
