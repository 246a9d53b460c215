"""Readers, raw-file unification and layer tables."""
