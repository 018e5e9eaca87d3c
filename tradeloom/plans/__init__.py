"""Marts and metrics over the silver tables."""
