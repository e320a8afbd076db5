"""Streaming sinks."""

from .sink import index_stream

__all__ = ["index_stream"]
