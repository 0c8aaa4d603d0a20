"""Readers, the Bronze snapshot ledger and published layer tables."""
