"""Annotation of records as they arrive, with the batch plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from strandmill.operators.annotate import annotate


def annotate_stream(records: DataFrame, winners: DataFrame, min_width: int, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Each micro-batch of records is annotated against the frozen window winners; write gets (rows, batch number) and must be idempotent by number."""
    return records.writeStream.foreachBatch(lambda rows, n: write(annotate(rows, winners, min_width), n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
