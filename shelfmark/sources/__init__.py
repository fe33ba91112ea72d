"""Readers and writers of the catalog pipeline."""
