"""Structured Streaming ingestion of landing directories."""
