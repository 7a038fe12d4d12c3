"""Whole pipelines: functional regions with controls, start codons of transcripts, and score statistics."""
