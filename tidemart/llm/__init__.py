"""Operators for large-scale training data: text, vectors, transcripts and sampling."""
