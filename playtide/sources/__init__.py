"""Readers for payload files, catalogue files and message streams, and file and topic writers."""
