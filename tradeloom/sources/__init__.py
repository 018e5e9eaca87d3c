"""Readers: the landing feed and the test tables."""
