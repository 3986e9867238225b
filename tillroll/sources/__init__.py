"""Inputs, tables and scratch storage."""
