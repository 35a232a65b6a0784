"""Readers and writers of files, and the adapters over the test tables."""
