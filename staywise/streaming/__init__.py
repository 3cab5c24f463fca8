"""Structured Streaming forms of scoring and of the log reports."""
