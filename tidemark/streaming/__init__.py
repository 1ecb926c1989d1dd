"""Structured Streaming forms: bins by watermark, the detector with state, and sinks."""
