"""Structured Streaming: event time, running, progress, late rows."""
from .late import amended, batches, split_late, watermark, with_window
from .run import late_rows, progress, run_stream, with_event_time
from .watch import RunCounts, StreamWatch

__all__ = [
    "RunCounts", "StreamWatch", "amended", "batches", "late_rows", "progress", "run_stream", "split_late", "watermark", "with_event_time",
    "with_window",
]
