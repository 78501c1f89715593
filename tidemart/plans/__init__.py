"""Whole batch jobs, composed of operators."""
