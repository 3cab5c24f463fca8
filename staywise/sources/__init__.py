"""Readers and writers: CSV, rows in memory, managed tables, JSON documents, models, the prediction log."""
