"""Structured Streaming forms of the merge and the de-duplication."""
