"""Structured Streaming: arrival-triggered profiling and deadline joins."""
