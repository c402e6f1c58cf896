"""Operators for text corpora: counting, encoding, cleaning, deduplicating and archiving documents.

Nothing outside this subpackage imports it.
"""
