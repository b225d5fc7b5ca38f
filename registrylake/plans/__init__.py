"""Pipelines and driver queries."""
