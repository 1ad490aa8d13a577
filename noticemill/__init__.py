"""Layoff-notice analytics on Spark."""
