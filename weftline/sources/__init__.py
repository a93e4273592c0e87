"""Logical tables and readers."""
