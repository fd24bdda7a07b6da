"""Streaming ingest of landing wave files."""

from trackframe.streaming.waves import process_files, stream_waves

__all__ = ["process_files", "stream_waves"]
