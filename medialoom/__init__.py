"""Spark-first media ingestion, filtering, enrichment and normalisation."""
