"""Operators for large-scale training-data pipelines over a table of documents (id, text, ...)."""
