"""Listing-evidence analytics as PySpark DataFrame jobs."""
