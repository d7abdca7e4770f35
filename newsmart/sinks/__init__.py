"""Sinks: topics, dead letters, serving tables and the lake."""
