"""Genomic-interval dataset engine on PySpark."""
