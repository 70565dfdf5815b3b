"""Operators and queries that prepare text for training language models."""
