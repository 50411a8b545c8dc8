"""Extraction from stored pages."""
