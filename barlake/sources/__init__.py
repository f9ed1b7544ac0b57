"""Readers for landed files and writers for the Bronze / Silver / Gold tables."""
