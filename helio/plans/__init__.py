"""Whole runs and the catalogue of checked queries."""
