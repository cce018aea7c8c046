"""Scans and sinks: CSV tables, JSON documents, observations, checkpoints."""
