"""Incremental landing. Every later step is a batch over current snapshots."""
