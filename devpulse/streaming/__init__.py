"""Structured Streaming plans, sinks and progress figures."""

from devpulse.streaming.etl import with_event_watermark, deduplicate_stream, stream_windows
from devpulse.streaming.sinks import write_windows_stream, write_console_stream, write_memory_stream
from devpulse.streaming.progress import dropped_by_watermark, rows_in_state

__all__ = ["with_event_watermark", "deduplicate_stream", "stream_windows", "write_windows_stream",
           "write_console_stream", "write_memory_stream", "dropped_by_watermark", "rows_in_state"]
