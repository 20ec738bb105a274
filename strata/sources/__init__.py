"""Readers, writers and the article view over the document tables."""
