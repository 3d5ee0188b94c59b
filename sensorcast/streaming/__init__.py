"""Structured Streaming twins of the batch operators (extensions X1, X2)."""
