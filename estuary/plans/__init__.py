"""Pipelines: whole analysis, QA checks and enrichment as lazy DataFrame graphs."""
