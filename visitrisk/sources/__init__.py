"""Typed readers and the matching writers."""
