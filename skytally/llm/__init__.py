"""Operators for preparing training corpora: deduplication, mixing, sharding, packing,
language identification and page extraction. Nothing else in the library imports this."""
