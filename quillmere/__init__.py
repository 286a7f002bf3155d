"""Quillmere: clinical-style data wrangling expressed as Spark plans."""
