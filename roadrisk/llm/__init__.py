"""Operators for large text corpora: extraction, scoring, joins, filters, binary and archive formats."""
