"""Stored events replayed through a stream in the order of their messages, without Kafka."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Messages of a slice, and slices at least.
SLICE_ROWS, LEAST_SLICES = 2_000_000, 3


def slices_of(messages: DataFrame, slices: int) -> list[DataFrame]:
    """``messages`` in consecutive ranges of the message time, cut at its quantiles; a
    missing time comes first. Equal times stay together, so there may be fewer."""
    time = F.coalesce(F.unix_micros("message_time"), F.lit(0))
    shares = [i / slices for i in range(1, slices)]
    cuts = sorted(set(messages.agg(F.percentile_approx(time, shares, 10_000)).first()[0] or [])) if shares else []
    bounds = zip([None, *cuts], [*cuts, None], strict=True)
    return [messages.filter((F.lit(True) if low is None else time > low) & (F.lit(True) if high is None else time <= high))
            for low, high in bounds]


def replay(messages: DataFrame, inbox: str, start: Callable[[], StreamingQuery],
           slices: int | None = None) -> list[StreamingQuery]:
    """Feed ``messages`` to a stream in consecutive ranges of the message time.

    Each range is written to ``inbox`` (many files, by all tasks) and then taken by
    one run of the stream, started by ``start`` on the same checkpoint. So keys
    arrive in order however the events are stored, and every run but the first is
    a restart. There are as many ranges as keep one at SLICE_ROWS messages, cut at
    quantiles of the times.
    """
    count = messages.count()
    if not count:
        raise ValueError("no messages to replay")
    runs = []
    for part in slices_of(messages, slices or max(LEAST_SLICES, -(-count // SLICE_ROWS))):
        part.write.mode("append").parquet(inbox)
        runs.append(start())
        runs[-1].awaitTermination()
    return runs
