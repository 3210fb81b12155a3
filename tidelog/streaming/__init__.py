"""Streaming versions of the batch operators, and what keeps them running."""
