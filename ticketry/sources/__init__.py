"""Readers and writers: tolerant CSV, row positions, prediction files, sinks."""
