from stratakeep.streaming.landing_stream import stream_landing
from stratakeep.streaming.satellite_stream import changed_rows, stream_satellite

__all__ = ["changed_rows", "stream_landing", "stream_satellite"]
