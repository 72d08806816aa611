"""Operators on records: normalising, filtering, deduplicating, validating, scoring, pairing and reporting."""
