"""Structured Streaming: bar streams, the SMA stream join, live indicators, sinks."""
