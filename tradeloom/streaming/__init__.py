"""Streams: sinks, de-duplication, change capture and the whole pipeline."""
