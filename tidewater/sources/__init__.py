"""Inputs: delimited text, time windows, JDBC reads, staged file runs."""
