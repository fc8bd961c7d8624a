"""Sinks: summary documents, metadata log, run results, comparison tables."""
