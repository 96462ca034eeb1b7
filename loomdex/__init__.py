"""Corpus ingest and ranked keyword search, expressed as Spark DataFrame jobs."""
