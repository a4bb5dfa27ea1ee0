"""Crawl-data processing and quality gating as Spark DataFrame operations."""
