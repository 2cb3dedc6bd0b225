"""Structured Streaming form of the incremental load."""
from .available_now import run_available_now, stream_frame

__all__ = ["run_available_now", "stream_frame"]
