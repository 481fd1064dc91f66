"""Whole jobs made of the operators: ingest, batch statistics, dashboard reads."""
