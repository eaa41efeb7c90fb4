"""Whole runs and the catalogue of queries."""
