"""Structured Streaming: the event operators on a growing log, de-duplication and gates with state."""
