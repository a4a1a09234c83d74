"""Corpus readers, writers and the counts reported while loading."""
