"""Relational operators: privacy, validation, identity, mapping, deduplication."""
