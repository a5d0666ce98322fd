"""Readers and writers of the pipeline's tables."""
