"""Readers and writers for source files, examples, results and logs."""
