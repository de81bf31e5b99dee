"""Readers and writers of the lake and of landed files."""
