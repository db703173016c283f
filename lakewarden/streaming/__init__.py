"""Structured Streaming operators. Streams carry ``timestamp`` event times, the type watermarks take."""

from lakewarden.streaming.capture import (
    ROCKSDB,
    assign_capture_files,
    capture_files,
    capture_stream,
    capture_windows,
    read_captured,
    split_capture_stream,
)
from lakewarden.streaming.live import (
    fan_out,
    read_latest,
    read_retained,
    retain_stream,
    run_available,
    stream_latest,
    stream_resample,
    stream_retention,
    write_latest,
)

__all__ = [
    "ROCKSDB",
    "assign_capture_files",
    "capture_files",
    "capture_stream",
    "capture_windows",
    "fan_out",
    "read_captured",
    "read_latest",
    "read_retained",
    "retain_stream",
    "run_available",
    "split_capture_stream",
    "stream_latest",
    "stream_resample",
    "stream_retention",
    "write_latest",
]
