"""Readers and writers, and the shapes derived from the test tables."""
