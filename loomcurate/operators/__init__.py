"""Relational operators of the curation pipeline, DataFrame to DataFrame."""
