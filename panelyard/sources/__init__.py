"""Readers, reshapers and validity checks for landed files."""
