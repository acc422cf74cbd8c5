"""Operators for preparing training text: filters, scans, deduplication and tokens over documents."""
