"""Landed files as a stream, and upserts with state."""

from shelftrack.streaming.landing_stream import landing_stream, load_stream, streaming_upsert
from shelftrack.streaming.state_stream import newest_per_key, state_upsert

__all__ = ["landing_stream", "load_stream", "newest_per_key", "state_upsert", "streaming_upsert"]
