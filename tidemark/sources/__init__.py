"""Readers and writers: staged files, workbooks, sheet CSV files, warehouse tables."""
