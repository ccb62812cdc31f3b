"""Readers: landed snapshot files, lookup results, registry tables."""
