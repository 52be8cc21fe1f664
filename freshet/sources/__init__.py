"""Readers and name parsers."""
