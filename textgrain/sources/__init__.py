"""Readers, writers and the mapping from raw tables to a labelled corpus."""
