"""Structured Streaming: mail sources, running rankings, sinks."""
