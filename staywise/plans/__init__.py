"""Whole jobs: the training and scoring workflow, and the queries on the given tables."""
