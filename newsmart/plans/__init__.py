"""Pipelines: compositions of the operators."""
