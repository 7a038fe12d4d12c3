"""Operators from DataFrame to DataFrame: intervals, windows, nearest sites, selection, controls, statistics, checks."""
