"""Whole runs, and the catalogue of registered queries."""
