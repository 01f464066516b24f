"""Readers: Bronze envelopes, landed pages, catalogued Silver tables."""
