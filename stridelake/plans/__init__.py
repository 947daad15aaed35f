"""Composed reports."""
