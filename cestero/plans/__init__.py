"""Compositions of operators: the summaries and the batch job."""
