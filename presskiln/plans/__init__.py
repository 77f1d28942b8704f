"""Compositions: article rows, the three kinds of run, the whole ingest."""
