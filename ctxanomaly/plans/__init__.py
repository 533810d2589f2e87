"""Compositions of operators: the end-to-end detection and the batch job."""
