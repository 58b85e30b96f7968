"""Operators for preparing training text: deduplication, scoring, extraction, decontamination, mixing."""
