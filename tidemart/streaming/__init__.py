"""Streaming jobs: topic in, operators, topic or table out."""
