"""Readers and writers of sequence, annotation, interval, score and label files."""
