"""Operators for preparing training text: rules, deduplication, filters, models."""
