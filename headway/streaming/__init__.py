"""Incremental landing of raw objects."""
