"""Millrace: a PySpark engine for semi-structured job-offer records."""
