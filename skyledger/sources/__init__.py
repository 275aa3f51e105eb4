"""Readers and writers: raw files, extracts, yearly tables, messages, result tables."""
