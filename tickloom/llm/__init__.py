"""Operators for preparing training text: deduplication, quality, mixing,
tokens, licences and secrets, each over a documents table."""
