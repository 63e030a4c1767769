"""A stream joined with a registry that changes while it runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.joins import enrich
from .fanout import BatchSink
from .live import writer


def start_enriched(
    rows: DataFrame,
    registry: Callable[[], DataFrame],
    sink: BatchSink,
    checkpoint: str,
    key: str = "service",
    mode: str = "update",
    trigger: str | None = "5 seconds",
) -> StreamingQuery:
    """``rows`` left-joined with the registry into ``sink``, one call per micro-batch.

    ``registry`` opens the table (one row per ``key``) and is called for every batch: a batch sees
    the files that are there when it starts. A plain join with a table opened once would keep the
    list of files of that moment.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        sink(enrich(batch, registry(), key), batch_id)

    return writer(rows, checkpoint, mode, trigger).foreachBatch(step).start()
