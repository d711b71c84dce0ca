"""Readers and writers: compact records, channel files, dimensions, serving tables."""
