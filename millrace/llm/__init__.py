"""Operators over text corpora and noisy records; nothing outside imports this package."""
