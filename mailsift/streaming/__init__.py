"""Structured Streaming form of the digest."""

from mailsift.streaming.incremental import incremental_digest_from_table, start_incremental_digest

__all__ = ["incremental_digest_from_table", "start_incremental_digest"]
