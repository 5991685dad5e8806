"""Corpus extraction, entity matching and ranked search as PySpark DataFrame jobs."""
