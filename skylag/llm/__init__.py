"""Operators for building training corpora out of text, pages and vectors."""
