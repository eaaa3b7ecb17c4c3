"""Readers and writers: file trees, packed snapshots, JSON records, catalog tables."""
