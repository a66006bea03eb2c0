"""Readers and writers: delimited files, tables, metrics documents."""
