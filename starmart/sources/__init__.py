"""Staging: extraction from the three kinds of source into staging tables."""
