"""Trigger choices."""

from __future__ import annotations

# The reference polls every 10 seconds.
DEFAULT_TRIGGER = {"processingTime": "10 seconds"}
# Drain what is there now, in as many micro-batches as the source limits allow, then stop.
AVAILABLE_NOW = {"availableNow": True}
# Bounds of one micro-batch, unless the caller gives others: a first run over a long history is cut into many.
MAX_FILES = 1000
MAX_OFFSETS = 5_000_000


def start(writer, checkpoint: str, trigger: dict | None = None, name: str | None = None):
    """Start a streaming write with a mandatory checkpoint (I6: restarts resume, never re-read)."""
    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    w = writer.option("checkpointLocation", checkpoint).trigger(**(trigger or DEFAULT_TRIGGER))
    if name:
        w = w.queryName(name)
    return w.start()


def run_to_end(query) -> None:
    """Block until the query stops (all available data for ``availableNow``); re-raise its error."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def dates_of(batch) -> list:
    """The dates of a micro-batch: one value a day."""
    return [r[0] for r in batch.select("event_date").distinct().collect() if r[0] is not None]
