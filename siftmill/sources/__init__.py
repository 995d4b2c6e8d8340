"""Readers of the project's text, table and site formats."""
