"""Streams of arriving records."""
