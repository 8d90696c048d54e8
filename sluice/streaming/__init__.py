"""Incremental loads with Structured Streaming (O-37)."""

from sluice.streaming.incremental import incremental_load, read_incremental

__all__ = ["incremental_load", "read_incremental"]
