"""Operators for preparing training text: deduplication, quality, decontamination, mixing, archives."""
