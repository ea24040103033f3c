"""Readers: regional extracts, staged files, seeds, and the given tables."""
