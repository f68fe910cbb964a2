"""Compositions: the served queries and the batch run."""
