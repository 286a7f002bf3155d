"""Operators for text corpora and entity data. Nothing else in the library imports this."""
