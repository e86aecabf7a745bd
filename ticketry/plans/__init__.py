"""Whole runs: files to unified tickets, publication of results, training."""
