"""Reporting tables, the staged pipeline and the catalogue of named queries."""
