"""Test inputs derived from the order tables."""
