"""Incremental sync over landed feed files (Structured Streaming) and runs on a
committed state."""

from rollcall.streaming.sync_stream import (  # noqa: F401
    output_folders, read_output, run_micro_batch, run_sync, sync_stream,
)
