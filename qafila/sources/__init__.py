"""Readers and writers: Parquet splits, JSON lines, checkpoint logs, JSON documents, settings and fingerprints."""
