"""Append-only conversion as a stream."""
