"""Incremental (Structured Streaming) form of the candle job."""
