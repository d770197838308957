"""Readers and writers: CSV files, format-selectable datasets, JDBC tables."""
