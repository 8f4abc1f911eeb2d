"""Readers, writers and SQL jobs."""
