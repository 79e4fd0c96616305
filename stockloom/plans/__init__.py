"""Whole runs: the layered warehouse, the forecast comparison and the full set of outputs."""
